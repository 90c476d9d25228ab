"""Helpers the training-data operators share: Arrow streams, texts, components."""

from __future__ import annotations

import importlib
import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import materialize, tune

# Bounds on what one Arrow batch holds; a text longer than this is a batch of its own.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def session(df_or_spark: DataFrame | SparkSession) -> SparkSession:
    """The session, with the settings that the operators rely on."""
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    tune(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def over_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` maps an iterator of record batches to one; Arrow on both sides."""
    session(df)
    # Tasks carry this package's functions with them; executors need not have it installed.
    cloudpickle.register_pickle_by_value(importlib.import_module("lakeloom.llm"))

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks

    return df.mapInArrow(run, schema)


def nested(batch: pa.RecordBatch, path: tuple[str, ...]) -> pa.Array:
    """A column, or a field of a struct column that has no nulls itself."""
    values = batch.column(path[0])
    for name in path[1:]:
        values = values.field(name)
    return values


def texts(batch: pa.RecordBatch, *path: str) -> list[bytes]:
    """A text column's (or field's) values as UTF-8 bytes; null becomes empty."""
    values = nested(batch, path)
    binary = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [v or b"" for v in values.cast(binary).to_pylist()]


BLANK = re.compile(rb"[\x20\x09-\x0d]")
RUN_BYTES = 1 << 22


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words between ASCII blanks, in lists of bounded size whatever the text's length."""
    at = 0
    while at < len(text):
        cut = BLANK.search(text, at + RUN_BYTES)
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        if words:
            yield words
        at = end


def record_batch(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    """A batch of named (values, type) columns."""
    arrays = [
        v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in columns.values()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + length`` of all ranges, one range after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component), at most one for each node."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        pl, pr = parent[left], parent[right]
        if (pl == pr).all():
            break
        low = np.minimum(pl, pr)
        np.minimum.at(parent, pl, low)
        np.minimum.at(parent, pr, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    linked = parent != np.arange(len(nodes))
    return nodes[linked], nodes[parent[linked]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``a, b`` (bigint).

    Returns ``node, root``: each node that has a link, and the smallest node it can
    reach. Alternates between linking every larger neighbour and every smaller
    neighbour to the local minimum, so that rounds grow with the logarithm of the
    longest chain. A round is written to the shared scratch folder, so that lost
    executors cost tasks only; the joins on a node with very many links are split by
    adaptive execution. Nothing but one checksum a round reaches the driver.
    """
    current = materialize(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),  # tasks find the links of a large group again and again
        "links",
    )
    seen = _checksum(current)
    while seen[0]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(lowest, "u")
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        current = materialize(small, "links")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _checksum(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def batches_of(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (b for b in iterator if b.num_rows)


def on_worker(name: str, make: Callable):
    """What ``make`` gives, kept by a Python worker for the tasks that come after."""
    store = sys.modules.setdefault("_lakeloom_worker", types.ModuleType("_lakeloom_worker"))
    if name not in vars(store):
        setattr(store, name, make())
    return getattr(store, name)


class Remembered:
    """Token ids of words; ``encode`` maps a list of words to (ids, number of each word).

    What is remembered is bounded: beyond ``limit`` bytes all is forgotten and learnt anew.
    """

    def __init__(self, encode: Callable, limit: int = 48 << 20):
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.known: dict = {}
        self.flat = np.empty(0, np.int32)
        self.starts = self.lengths = np.empty(0, np.int64)
        self.held = 0

    def places(self, words) -> np.ndarray:
        """Where the words are in ``starts`` and ``lengths``, until the next call."""
        found = self._look_up(words)
        new = list(dict.fromkeys(words[i] for i in np.flatnonzero(found < 0).tolist()))
        if not new:
            return found
        if self.held > self.limit:
            self._forget()
            new = list(dict.fromkeys(words))
        flat, lengths = self.encode(new)
        first = len(self.starts)
        self.known.update(zip(new, range(first, first + len(new))))
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.held += sum(map(len, new)) + 4 * len(flat) + 160 * len(new)
        return self._look_up(words)

    def _look_up(self, words) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def ids(self, places: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.starts[places], self.lengths[places])]


def gathered(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in fewer batches, of about ``size`` bytes in the column or one row."""
    held, total = [], 0
    for batch in batches_of(batches):
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
