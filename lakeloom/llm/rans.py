"""Token ids in compressed files: static range asymmetric numeral systems (rANS).

Files. A data set is a folder with three tables that Spark writes and commits:

- ``tables``: the id frequencies of the whole data set (``id, count``), shared by all blocks;
- ``blocks``: one row a block: ``shard`` and ``block`` give its place, ``first`` its number
  of ids before it in the shard, and ``payload`` its bytes;
- ``shards``: ids in each shard and before it.

A block's payload is a header, the documents that have ids in it, checkpoints and 32-bit
words. Ids go round robin to ``LANES`` coders whose words are interleaved, so that numpy
codes all lanes at once. Every block starts from its own states and is checked by a CRC-32
of its ids, so blocks decode in parallel; checkpoints (lane states and word offset every
``CHECKPOINT`` ids) let a part of a block be decoded alone. A document longer than a block
goes on in the next ones.

Order. Documents are in ascending id order over shards, then blocks. The range partitioner
gets the id and a row number as keys, so that an id that very many rows repeat is dealt out
over shards like different ids.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.shared import (
    Remembered,
    batches_of,
    gathered,
    on_worker,
    over_batches,
    ragged,
    record_batch,
    session,
)
from lakeloom.session import materialize, scratch_path

LANES = 1024
BLOCK = 1 << 18  # ids in a block
CHECKPOINT = 1 << 17  # ids between checkpoints, a multiple of LANES
SHARD = 1 << 24  # ids in a shard, about
LOW = np.uint64(1 << 31)  # states are from here up to 2^63
WORD_BITS = np.uint64(32)
HEADER = "<4sIIIII"  # magic, ids, documents, checkpoints, words, crc32 of the ids
MAGIC = b"rANS"
MAX_IDS = 1 << 20  # different ids: bounds what the driver and every task hold to 16 MB

# --- tokenising --------------------------------------------------------------------

# A word of Latin letters is one pre-token of the tokenizer; it is encoded without its
# normalising and splitting. Plain punctuation behind it is another one. All other words go
# through the whole tokenizer as they are.
LETTERS = re.compile("[a-zÀ-ÖØ-öø-įı-ɏ]*")
TAIL = ".,!?;:"
REMEMBERED_STEMS, REMEMBERED_WORDS = 96 << 20, 16 << 20  # bytes in a Python worker
TEXT_AT_ONCE = 8 << 20  # bytes; the more, the fewer words are looked up again


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet for the letters above: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x2C0)}


class WordTokenizer:
    """Ids of texts, word by word; white space only parts words for this tokenizer."""

    def __init__(self, definition: str):
        self.full = Tokenizer.from_str(definition)
        self.bare = Tokenizer(self.full.model)  # words that need no normalising or splitting
        self.end = np.zeros(self.full.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.bare.get_vocab(with_added_tokens=False).items():
            self.end[i] = token.endswith("</w>")
        self.letters = byte_letters()
        self.stems = Remembered(self._encode_stems, REMEMBERED_STEMS)
        self.words = Remembered(self._encode_words, REMEMBERED_WORDS)

    def _encode_stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words of letters; other stems, and the empty one, have no ids here."""
        simple = [i for i, s in enumerate(stems) if s and LETTERS.fullmatch(s)]
        parts = [
            s if s.isascii() else s.lower().translate(self.letters)
            for s in (stems[i] for i in simple)
        ]
        lengths = np.zeros(len(stems), np.int64)
        if not parts:
            return np.empty(0, np.int32), lengths
        groups = [parts[k : k + 500] for k in range(0, len(parts), 500)]
        codes = self.bare.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.int32) for e in codes])
        stops = np.flatnonzero(self.end[flat]) + 1
        if len(stops) != len(parts):
            raise ValueError("a word's last token does not show its end")
        lengths[simple] = np.diff(np.r_[0, stops])
        return flat, lengths

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = self.full.encode_batch_fast(words, add_special_tokens=False)
        found = [np.array(c.ids, np.int32) for c in codes]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([*found, np.empty(0, np.int32)]), lengths

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = split.flatten()
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = flat.dictionary_encode()
        words = coded.dictionary
        # Distinct words are a stem and a tail of punctuation; few stems are no letters only.
        trimmed = pc.utf8_rtrim(words, TAIL)
        stem = pc.ascii_lower(trimmed).dictionary_encode()
        first = self.stems.places(strings(stem.dictionary))[stem.indices.to_numpy()]
        letters = pa.array(self.stems.lengths[first] > 0, pa.bool_())
        longer = pc.not_equal(pc.binary_length(words), pc.binary_length(trimmed))
        tail = pc.replace_with_mask(
            pc.if_else(letters, "", words),
            pc.and_(letters, longer),
            pc.replace_substring_regex(
                words.filter(pc.and_(letters, longer)), f"^.*?([{TAIL}]+)$", r"\1"
            ),
        ).dictionary_encode()
        rest = self.words.places(strings(tail.dictionary))[tail.indices.to_numpy()]
        # The ids of the distinct words, then those of the words in order.
        ids = np.concatenate([self.stems.flat, self.words.flat])
        starts = np.stack([self.stems.starts[first], self.words.starts[rest] + len(self.stems.flat)], 1)
        lengths = np.stack([self.stems.lengths[first], self.words.lengths[rest]], 1)
        ids = ids[ragged(starts.ravel(), lengths.ravel())]
        lengths = lengths.sum(axis=1)
        starts = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy()
        lengths = lengths[at]
        line = ids[ragged(starts[at], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][offsets]
        return [line[a:b] for a, b in zip(ends[:-1], ends[1:])]


def strings(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def tokenize(docs: DataFrame, definition: str, end_id: int, text: str = "text") -> DataFrame:
    """``doc_id, row, n, ids``: little-endian ids (16 bits if all fit), the end id last.

    ``row`` numbers the rows of a task; with the task's number it tells rows of the same id
    apart.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    name = f"tokenizer_{zlib.crc32(definition.encode())}"

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = on_worker(name, lambda: WordTokenizer(definition))
        kind = "<u2" if max(len(tokenizer.end), end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        for batch in gathered(batches, "text", TEXT_AT_ONCE):
            found = tokenizer.encode(batch.column("text"))
            yield record_batch(
                {
                    "doc_id": (batch.column("doc_id"), pa.int64()),
                    "row": (batch.column("row"), pa.int64()),
                    "n": ([len(f) + 1 for f in found], pa.int64()),
                    "ids": ([f.astype(kind).tobytes() + end for f in found], pa.binary()),
                }
            )

    return over_batches(rows, run, "doc_id bigint, row bigint, n bigint, ids binary")


def numbers(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype(np.uint32)


# --- coding ------------------------------------------------------------------------


class Table:
    """Frequencies scaled to a power of two, and the way back from a slot to an id."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = ids[order].astype(np.uint32), counts[order].astype(np.float64)
        if len(ids) > MAX_IDS:
            raise ValueError(f"more than {MAX_IDS} different ids")
        self.bits = max(12, int(np.ceil(np.log2(max(len(ids), 1)))) + 4)
        size = 1 << self.bits
        scaled = np.maximum(np.floor(counts * (size / max(counts.sum(), 1))), 1).astype(np.int64)
        # Rounding down leaves room, ones for rare ids may take too much: the largest settle it.
        for i in np.argsort(-scaled, kind="stable"):
            excess = int(scaled.sum()) - size
            if excess == 0:
                break
            scaled[i] = max(1, scaled[i] - excess)
        self.freq = scaled.astype(np.uint64)
        self.start = (np.cumsum(scaled) - scaled).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(int))
        return self._slots

    def code(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(words, checkpoints) of a block; a checkpoint is a word offset and lane states."""
        n = len(ids)
        at = np.searchsorted(self.ids, ids)
        freq, start = self.freq[at], self.start[at]
        bits = np.uint64(self.bits)
        limit = freq << np.uint64(63 - self.bits)
        state = np.full(LANES, LOW, np.uint64)
        steps = -(-n // LANES)
        words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
        marks = {}
        for step in range(steps - 1, -1, -1):
            here = slice(step * LANES, min(n, (step + 1) * LANES))
            x = state[: here.stop - here.start]
            full = x >= limit[here]
            words[step] = x[full].astype(np.uint32)
            x = np.where(full, x >> WORD_BITS, x)
            whole = x // freq[here]
            state[: len(x)] = (whole << bits) + (x - whole * freq[here]) + start[here]
            if step * LANES % CHECKPOINT == 0:
                marks[step] = state.copy()
        before = np.cumsum([0, *map(len, words)])
        points = [np.r_[np.uint64(before[step]), marks[step]] for step in sorted(marks)]
        return np.concatenate([*words, np.empty(0, np.uint32)]).astype("<u4").tobytes(), (
            np.array(points, "<u8").reshape(-1, LANES + 1)
        )

    def decode(
        self, words: np.ndarray, point: np.ndarray, first: int, last: int
    ) -> np.ndarray:
        """Ids ``first`` to ``last`` of a block, from the checkpoint at ``first``."""
        offset, state = int(point[0]), point[1:].astype(np.uint64)
        slots, bits, mask = self.slots, np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        out = np.empty(last - first, np.uint32)
        for at in range(0, last - first, LANES):
            x = state[: min(LANES, last - first - at)]
            slot = x & mask
            symbol = slots[slot]
            out[at : at + len(x)] = symbol
            x = self.freq[symbol] * (x >> bits) + slot - self.start[symbol]
            empty = np.flatnonzero(x < LOW)
            if len(empty):
                x[empty] = (x[empty] << WORD_BITS) | words[offset : offset + len(empty)]
                offset += len(empty)
            state[: len(x)] = x
        return self.ids[out]


@dataclass
class Part:
    """Ids of one document in one block."""

    doc_id: int | None
    row: int
    skipped: int  # ids of the document in earlier blocks
    n: int
    total: int  # ids of the document in all blocks


PART = np.dtype([("null", "<u8")] + [(f, "<i8") for f in "doc_id row skipped n total".split()])


def pack(table: Table, ids: np.ndarray, parts: list[Part]) -> bytes:
    words, points = table.code(ids)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    header = struct.pack(HEADER, MAGIC, len(ids), len(parts), len(points), len(words) // 4, crc)
    listed = np.array(
        [(p.doc_id is None, p.doc_id or 0, p.row, p.skipped, p.n, p.total) for p in parts], PART
    )
    return b"".join([header, listed.tobytes(), points.tobytes(), words])


def unpack(
    table: Table, payload: bytes, first: int = 0, last: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(documents' parts, ids ``first`` to ``last``); a whole block is checked by its CRC."""
    magic, n, n_parts, n_points, n_words, crc = struct.unpack_from(HEADER, payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = struct.calcsize(HEADER)
    parts = np.frombuffer(payload, PART, n_parts, at)
    at += parts.nbytes
    points = np.frombuffer(payload, "<u8", n_points * (LANES + 1), at).reshape(-1, LANES + 1)
    at += points.nbytes
    words = np.frombuffer(payload, "<u4", n_words, at).astype(np.uint64)
    last = n if last is None else min(last, n)
    begin = min(first // CHECKPOINT, max(n_points - 1, 0))
    if first >= last:
        return parts, np.empty(0, np.uint32)
    ids = table.decode(words, points[begin], begin * CHECKPOINT, last)[first - begin * CHECKPOINT :]
    if first == 0 and last == n and zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's ids do not have its checksum")
    return parts, ids


def cut_blocks(rows: Iterator[tuple[int | None, int, np.ndarray]]):
    """Blocks of (ids, parts) from documents in order."""
    held, parts, size = [], [], 0
    for doc_id, row, ids in rows:
        done = 0
        while done < len(ids):
            take = min(len(ids) - done, BLOCK - size)
            held.append(ids[done : done + take])
            parts.append(Part(doc_id, row, done, take, len(ids)))
            done += take
            size += take
            if size == BLOCK:
                yield np.concatenate(held), parts
                held, parts, size = [], [], 0
    if size:
        yield np.concatenate(held), parts


def crc32_joined(first: int, second: int, length: int) -> int:
    """CRC-32 of two joined byte strings from theirs and the second's length.

    Appending zero bytes is linear over the bits of the CRC; its powers of two are squared up.
    """

    def times(matrix: list[int], vector: int) -> int:
        total = 0
        for bit in range(32):
            if vector >> bit & 1:
                total ^= matrix[bit]
        return total

    one_bit = [0xEDB88320] + [1 << i for i in range(31)]
    matrix = one_bit
    for _ in range(3):
        matrix = [times(matrix, row) for row in matrix]
    while length:
        if length & 1:
            first = times(matrix, first)
        length >>= 1
        if length:
            matrix = [times(matrix, row) for row in matrix]
    return first ^ second


# --- files -------------------------------------------------------------------------


def write(docs: DataFrame, definition: str, path: str, end_id: int = 1) -> None:
    """Tokenise all documents and write them below ``path`` (a folder that does not exist).

    A null or empty text is the end id alone. Rows without an id come first; rows that repeat
    an id all stay, in no particular order among themselves.
    """
    spark = session(docs)
    raw = scratch_path(spark, "token-ids")
    tokenize(docs, definition, end_id).write.option("compression", "zstd").parquet(raw)
    rows = spark.read.parquet(raw)

    def count(batches):
        held = np.zeros(1 << 16, np.int64)
        for batch in batches_of(batches):
            ids = np.concatenate(
                [
                    numbers(i, n)
                    for i, n in zip(
                        batch.column("ids").to_pylist(), batch.column("n").to_pylist()
                    )
                ]
            )
            seen = np.bincount(ids, minlength=len(held))
            seen[: len(held)] += held
            held = seen
        some = np.flatnonzero(held)
        yield record_batch({"id": (some, pa.int64()), "count": (held[some], pa.int64())})

    counted = over_batches(rows.select("ids", "n"), count, "id bigint, count bigint")
    counted.groupBy("id").agg(F.sum("count").alias("count")).write.parquet(f"{path}/tables")
    frequencies = read_table(spark, path)
    total = int(frequencies[:, 1].sum())
    shared = spark.sparkContext.broadcast(frequencies)  # at most one entry an id of the tokenizer

    def blocks(batches):
        table = table_of(shared.value)
        shard = None

        def documents():
            nonlocal shard
            for batch in batches_of(batches):
                shard = batch.column("shard")[0].as_py()  # the same in all rows of a task
                for doc_id, row, n, ids in zip(*[c.to_pylist() for c in batch.columns[:4]]):
                    yield doc_id, row, numbers(ids, n)

        first = 0
        for number, (ids, parts) in enumerate(cut_blocks(documents())):
            yield record_batch(
                {
                    "shard": ([shard], pa.int64()),
                    "block": ([number], pa.int64()),
                    "first": ([first], pa.int64()),
                    "n": ([len(ids)], pa.int64()),
                    "payload": ([pack(table, ids, parts)], pa.binary()),
                }
            )
            first += len(ids)

    shards = int(total // SHARD) + spark.sparkContext.defaultParallelism
    ordered = (
        rows.repartitionByRange(shards, "doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "row", "n", "ids", F.spark_partition_id().cast("bigint").alias("shard"))
    )
    over_batches(
        ordered, blocks, "shard bigint, block bigint, first bigint, n bigint, payload binary"
    ).write.option("compression", "none").parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n").alias("n"))
    before, listed = 0, []
    for shard, n in sorted((r.shard, r.n) for r in sizes.collect()):  # one row a shard
        listed.append((shard, n, before))
        before += n
    spark.createDataFrame(listed, "shard bigint, n bigint, before bigint").coalesce(1).write.parquet(
        f"{path}/shards"
    )


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """Rows of (id, count), in ascending order of ids."""
    rows = spark.read.parquet(f"{path}/tables").limit(MAX_IDS + 1).collect()
    if len(rows) > MAX_IDS:
        raise ValueError(f"more than {MAX_IDS} different ids")
    both = np.array([(r["id"], r["count"]) for r in rows], np.int64).reshape(-1, 2)
    return both[np.argsort(both[:, 0])]


def table_of(frequencies: np.ndarray) -> Table:
    return Table(frequencies[:, 0], frequencies[:, 1])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, row, start, skipped, n, total, ids``: each document's part in a block.

    ``start`` counts the ids of the data set before the part, ``skipped`` those of the
    document in earlier blocks; nearly all documents have one part, with ``n = total`` ids.
    """
    ids = lambda found: pa.array(found, pa.list_(pa.int64()))
    return _read(spark, path, ids, "ids array<bigint>")


def _read(spark: SparkSession, path: str, value, declared: str) -> DataFrame:
    """The parts, with what ``value`` makes of the list of their ids."""
    session(spark)
    shared = spark.sparkContext.broadcast(read_table(spark, path))
    before = {r.shard: r.before for r in spark.read.parquet(f"{path}/shards").collect()}
    rows = spark.read.parquet(f"{path}/blocks").select("shard", "first", "payload")
    numbers_of = ["row", "start", "skipped", "n", "total"]

    def run(batches):
        table = table_of(shared.value)
        for batch in batches_of(batches):
            for shard, first, payload in zip(*[c.to_pylist() for c in batch.columns]):
                parts, ids = unpack(table, payload)
                ends = np.cumsum(parts["n"])
                found = dict(zip(parts.dtype.names, [parts[c] for c in parts.dtype.names]))
                found["start"] = before[shard] + first + ends - parts["n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts["doc_id"], pa.int64(), mask=parts["null"].astype(bool))]
                    + [pa.array(found[c], pa.int64()) for c in numbers_of]
                    + [value(np.split(ids, ends[:-1]))],
                    names=["doc_id", *numbers_of, declared.split()[0]],
                )

    names = ", ".join(f"{c} bigint" for c in ["doc_id", *numbers_of])
    return over_batches(rows, run, f"{names}, {declared}")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``ids_crc32`` is the CRC-32 of the ids as little-endian 32-bit numbers. Only documents
    that go over blocks meet in a shuffle, with one small row a block; their CRCs are joined
    by arithmetic.
    """

    def crcs(found):
        return pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in found], pa.int64())

    @F.udf("bigint")
    def joined(pieces):
        total = pieces[0]["crc"]
        for piece in pieces[1:]:
            total = crc32_joined(total, piece["crc"], 4 * piece["n"])
        return total

    # The files are decoded once, though their parts are asked for twice.
    parts = materialize(_read(spark, path, crcs, "crc bigint"), "parts")
    alone = parts.where("n = total").select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )
    several = (
        parts.where("n < total")
        .groupBy("doc_id", "row")
        .agg(
            F.min("start").alias("start"),
            F.sum("n").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("skipped", "n", "crc"))).alias("pieces"),
        )
        .select("doc_id", "start", "n_tokens", joined("pieces").alias("ids_crc32"))
    )
    return alone.unionByName(several)


def definition_of(path: str) -> str:
    """A tokenizer's definition has a few megabytes; it travels with the tasks."""
    return Path(path).read_text(encoding="utf-8")
