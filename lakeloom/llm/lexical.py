"""Ranked lexical search: item terms times document impacts, dense tiles by BLAS.

Score. For an item (query) the scores of its distinct terms are summed: a term's weight
``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` times the document's impact
``(10^9 tf) div (1000 tf + 8 m)`` with ``m = 10 + (90 n N) div L``. ``N`` documents have
terms, ``L`` is the number of all their terms, ``n`` that of one document.

Method. The terms of the items are the vocabulary, so that its size follows the items and
not the corpus. One pass over the texts keeps of every document its length and the counts
of vocabulary terms; it is written, as the weights need totals of all documents. A second
pass takes documents in tiles. Per tile of the vocabulary, reduced to the terms that the
tile's documents have, a float64 matrix of item weights is multiplied with one of
impacts. All entries are whole numbers, an impact is at most 10^6, and a tile's weights
are cut so that no sum of products reaches 2^53: float64 is exact whatever the order of
summation, and tiles are added as 64-bit integers.

Top k. Per tile and item the k best by score, then smaller id, go on to the task's k best,
and the tasks' to the result: nothing below a k-th place that ties with it is dropped
before its id was compared.

Bounds. Items go in slices of ``SLICE_BYTES`` of text, each with a pass of its own; a
slice's vocabulary, and nothing else, is broadcast. A tile has ``CELLS`` cells. A task
hands on k rows an item, whatever the number of its documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lakeloom.llm.shared import gathered, over_batches, record_batch, session
from lakeloom.llm.words import kinds, words_of
from lakeloom.session import materialize

TERM = kinds(
    [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
)
SLICE_BYTES = 4 << 20
CELLS = 1 << 22  # of a matrix of impacts, and of one of item weights
VOCABULARY_TILE = 4096
ITEM_TILE = 1024
EXACT = 1 << 53
SCALE, MOST = 10**9, 10**6  # the impact's scale and its greatest value
BATCH_BYTES = 8 << 20


def slices(items: DataFrame, item_id: str, text: str, limit: int):
    """The items as lists of (id, text bytes), each list of about ``limit`` bytes."""
    rows = items.select(
        F.col(f"`{item_id}`").cast("bigint").alias("item_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.lit(1).alias("row"),
    )
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(total // limit) + 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        found = [(r.item_id, r.text) for r in part.select("item_id", "text").collect()]
        if found:
            yield found


class Items:
    """A slice of items: its vocabulary, and which terms each item has."""

    def __init__(self, items: list[tuple[int | None, str]]):
        found = words_of(pa.array([t for _, t in items], pa.string()), TERM)
        self.vocabulary = found.dictionary
        size = max(len(self.vocabulary), 1)
        pairs = np.unique(found.rows * size + found.codes)
        self.item, self.term = pairs // size, pairs % size
        self.n = len(items)


def term_counts(docs: DataFrame, items, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of each document that has terms.

    ``terms`` are codes of the broadcast items' vocabulary, ascending.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )

    def run(batches):
        vocabulary = items.value.vocabulary
        for batch in gathered(batches, "text", BATCH_BYTES):
            found = words_of(batch.column("text"), TERM)
            n = np.bincount(found.rows, minlength=batch.num_rows)
            place = pc.fill_null(pc.index_in(found.dictionary, vocabulary), -1).to_numpy()
            code = place[found.codes] if len(place) else found.codes
            known = code >= 0
            size = max(len(vocabulary), 1)
            keys, counts = np.unique(found.rows[known] * size + code[known], return_counts=True)
            rows = np.flatnonzero(n)
            ends = np.searchsorted(keys, np.r_[rows, batch.num_rows] * size)
            offsets = pa.array(ends.astype(np.int32))
            yield record_batch(
                {
                    "doc_id": (batch.column("doc_id").take(pa.array(rows)), pa.int64()),
                    "n": (n[rows], pa.int64()),
                    "terms": (lists(offsets, (keys % size).astype(np.int32)), None),
                    "counts": (lists(offsets, counts.astype(np.int32)), None),
                }
            )

    return over_batches(
        rows, run, "doc_id bigint, n bigint, terms array<int>, counts array<int>"
    )


def lists(offsets: pa.Array, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def cuts(weights: np.ndarray) -> list[tuple[int, int]]:
    """Tiles of the vocabulary of which no document's sum of products reaches 2^53."""
    found, start, held = [], 0, 0
    for i, w in enumerate(weights.tolist()):
        if i > start and (i - start >= VOCABULARY_TILE or (held + w) * MOST >= EXACT):
            found.append((start, i))
            start, held = i, 0
        held += w
    return [*found, (start, len(weights))] if len(weights) else []


def impacts(counts: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Of each (count, document's length); the length's part may pass 64 bits before ``div``."""
    lengths, back = np.unique(n, return_inverse=True)
    m = np.array([10 + 90 * x * docs // terms for x in lengths.tolist()], np.int64)[back]
    return (SCALE * counts) // (1000 * counts + 8 * m)


class Best:
    """The k best (score, then smaller id, nulls last) of each item so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * n

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of a tile of documents, a row an item; the ids ascend, nulls last."""
        # Equal scores stay in order of the ids, so the first k of them are the right ones.
        order = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        tops = np.take_along_axis(scores, order, 1)
        for i in np.flatnonzero(tops[:, 0] > 0).tolist():
            good = tops[i] > 0
            at = order[i][good]
            new = tops[i][good], ids[at], null[at]
            if self.found[i] is not None:
                new = tuple(np.concatenate(both) for both in zip(self.found[i], new))
            first = np.lexsort((new[1], new[2], -new[0]))[: self.k]
            self.found[i] = tuple(values[first] for values in new)


def tile_scores(shared, best: Best, ids, null, n, rows, terms, counts) -> None:
    """Scores of all items for one tile of documents, added to the best."""
    items, weights, tiles, docs, total = shared
    scores = np.zeros((items.n, len(ids)), np.int64)
    impact = impacts(counts.astype(np.int64), n[rows], docs, total)
    for a, b in tiles:
        here = (terms >= a) & (terms < b)
        present, column = np.unique(terms[here], return_inverse=True)
        if not len(present):
            continue
        right = np.zeros((len(present), len(ids)))
        right[column, rows[here]] = impact[here]
        chosen = np.isin(items.term, present)
        item, place = items.item[chosen], np.searchsorted(present, items.term[chosen])
        for first in range(0, items.n, ITEM_TILE):
            last = min(first + ITEM_TILE, items.n)
            mine = (item >= first) & (item < last)
            left = np.zeros((last - first, len(present)))
            left[item[mine] - first, place[mine]] = weights[present[place[mine]]]
            scores[first:last] += (left @ right).astype(np.int64)
    best.add(scores, ids, null)


def best_of(counted: DataFrame, shared, k: int) -> DataFrame:
    """``item, doc_id, score``: each task's k best documents of each item."""

    def run(batches):
        value = shared.value
        items, _, tiles, _, _ = value
        widest = max((b - a for a, b in tiles), default=1)
        size = max(1, min(CELLS // widest, CELLS // max(items.n, 1)))
        best = Best(items.n, k)
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                part = part.take(pc.sort_indices(part, [("doc_id", "ascending")]))
                doc_id, terms = part.column("doc_id"), part.column("terms")
                tile_scores(
                    value,
                    best,
                    doc_id.fill_null(0).to_numpy(),
                    doc_id.is_null().to_numpy(zero_copy_only=False),
                    part.column("n").to_numpy(),
                    np.repeat(np.arange(part.num_rows), pc.list_value_length(terms).to_numpy()),
                    terms.flatten().to_numpy(),
                    part.column("counts").flatten().to_numpy(),
                )
        for i, found in enumerate(best.found):
            if found is None:
                continue
            scores, ids, null = found
            yield record_batch(
                {
                    "item": (np.full(len(ids), i), pa.int64()),
                    "doc_id": (pa.array(ids, mask=null), None),
                    "score": (scores, pa.int64()),
                }
            )

    return over_batches(counted, run, "item bigint, doc_id bigint, score bigint")


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item.

    Documents score above 0; equal scores go by ascending document id, nulls last. Null,
    empty and termless texts match nothing on either side and count in no total; an item
    without a match has no rows. Every row is an item or a document of its own: rows that
    repeat an id are ranked each for itself. Other columns are ignored. Tables without
    rows give none.
    """
    spark = session(docs)
    found = None
    for part in slices(items, item_id, text, slice_bytes):
        shared = spark.sparkContext.broadcast(Items(part))
        seen = Observation()
        counted = term_counts(docs, shared, doc_id, text).observe(
            seen, F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")
        )
        counted = materialize(counted, "terms")
        total_docs, total = seen.get.get("docs", 0), seen.get.get("terms") or 0
        value = shared.value
        weights = np.zeros(len(value.vocabulary), np.int64)
        # One row for each term of the slice.
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[r["t"]] = weight(total_docs, r["count"])
        if not total:
            continue
        known = spark.sparkContext.broadcast((value, weights, cuts(weights), total_docs, total))
        ids = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(part)], "item bigint, item_id bigint"
        )
        window = Window.partitionBy("item").orderBy(
            F.col("score").desc(), F.col("doc_id").asc_nulls_last()
        )
        ranked = (
            best_of(counted, known, k)
            .withColumn("rank", F.row_number().over(window))
            .where(F.col("rank") <= k)
            .join(ids, "item")
            .select("item_id", "rank", "doc_id", "score")
        )
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found
