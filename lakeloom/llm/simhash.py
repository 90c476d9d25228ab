"""Near-duplicate documents by 64-bit SimHash; links found at anchors of a covering code.

Method. The 64 bits are cut into two Golay [23,12] words and two repetition words of
nine bits. All four codes are perfect, so every word lies within the covering radius
(3, 3, 4, 4 bits) of exactly one code word of its part; the anchors are the 2^26
combinations. Two fingerprints within ``max_bits`` of each other have a midpoint within
``ceil(max_bits / 2)`` bits of both, and the anchor that covers the midpoint is, part
by part, within the covering radius plus the bits spent in that part. So every
fingerprint is copied to all anchors within covering radius plus half the threshold
(about 71 for four bits), both ends of every link meet at one of them, and pairs are
compared bit by bit there. Copying one side by the whole threshold instead finds the
same links with some twenty times the rows.

The rows of every anchor are counted first. Those of an anchor above a bound are cut into
blocks by a hash, and every pair of blocks is a group of its own, so that no task holds a
hot anchor whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import (
    ASCII_LOWER,
    batches_of,
    components,
    forest,
    over_batches,
    record_batch,
    texts,
    unused,
    word_runs,
)
from lakeloom.session import materialize

SEED = 42
GOLAY_BITS, GOLAY_RADIUS = 23, 3
GOLAY_POLYNOMIAL = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
REPEAT_BITS, REPEAT_RADIUS = 9, 4
SHINGLES_AT_ONCE = 1 << 16
DENSE_GROUP = 512
HOT_ROWS = 1 << 16  # rows of one group; beyond 2^30 fingerprints their number / HOT_SHARE
HOT_SHARE = 1 << 14


def fingerprint(text: bytes, shingle_words: int) -> int:
    """SimHash of one text: a bit is 1 if set in over half of the shingles' hashes."""
    votes, n, held = np.zeros(64, np.int64), 0, []
    for words in word_runs(text.translate(ASCII_LOWER)):
        words = held + words
        if len(words) >= shingle_words:
            found, votes_of = shingle_votes(words, shingle_words)
            n, votes = n + found, votes + votes_of
            words = words[len(words) - shingle_words + 1 :]
        held = words
    if not n and held:
        n, votes = shingle_votes(held, len(held))
    bits = np.packbits((2 * votes > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def shingle_votes(words: list[bytes], size: int) -> tuple[int, np.ndarray]:
    """(number of shingles, how many of their hashes have each bit set)."""
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first = (ends - lengths)[: len(words) - size + 1].tolist()
    last = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for i in range(0, len(first), SHINGLES_AT_ONCE):
        some = slice(i, i + SHINGLES_AT_ONCE)
        hashes = [digest(line[s:e], SEED) for s, e in zip(first[some], last[some])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(first), votes


def fingerprints(
    docs: DataFrame, shingle_words: int = 4, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed bigint) for every row; null text is empty."""

    def run(batches):
        for batch in batches_of(batches):
            fps = [fingerprint(t, shingle_words) for t in texts(batch, "text")]
            yield record_batch(
                {"doc_id": (batch.column("doc_id"), pa.int64()), "fp": (fps, pa.int64())}
            )

    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return over_batches(rows, run, "doc_id bigint, fp bigint")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits (a signed number's bits are counted without its sign, so unsigned)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


class Anchors:
    """Code words within covering radius plus ``slack`` bits of a fingerprint."""

    def __init__(self, slack: int):
        self.slack = slack
        remainders = []
        for bit in range(GOLAY_BITS):
            value = 1 << bit
            for shift in range(bit - 11, -1, -1):
                if value >> (shift + 11) & 1:
                    value ^= GOLAY_POLYNOMIAL << shift
            remainders.append(value)
        self.syndromes = np.zeros(1 << 12, np.int32), np.zeros(1 << 11, np.int32)
        for part, shift in ((0, 0), (1, 12)):
            values = np.arange(len(self.syndromes[part]))
            for bit in range(12 - part):
                on = (values >> bit & 1).astype(bool)
                self.syndromes[part][on] ^= remainders[shift + bit]
        # For each syndrome, the error words up to the radius plus slack, lightest first.
        errors: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
        for weight in range(GOLAY_RADIUS + slack + 1):
            for bits in combinations(range(GOLAY_BITS), weight):
                syndrome = word = 0
                for bit in bits:
                    syndrome ^= remainders[bit]
                    word |= 1 << bit
                errors[syndrome].append((word, max(0, weight - GOLAY_RADIUS)))
        longest = max(map(len, errors))
        self.errors = np.zeros((1 << 11, longest), np.int64)
        self.excess = np.full((1 << 11, longest), 99, np.int8)
        for syndrome, found in enumerate(errors):
            for k, (word, over) in enumerate(found):
                self.errors[syndrome, k], self.excess[syndrome, k] = word, over

    def _golay(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        syndrome = self.syndromes[0][words & 0xFFF] ^ self.syndromes[1][words >> 12]
        return words[:, None] ^ self.errors[syndrome], self.excess[syndrome]

    @staticmethod
    def _repeat(words: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(words).astype(np.int8)
        distance = np.stack([ones, REPEAT_BITS - ones], axis=1)
        return np.maximum(distance - REPEAT_RADIUS, 0)

    def of(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor) for all anchors in reach."""
        x = fps.view(np.uint64)
        part = lambda shift, bits: ((x >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(
            np.int64
        )
        c1, e1 = self._golay(part(0, 23))
        c2, e2 = self._golay(part(23, 23))
        e3, e4 = self._repeat(part(46, 9)), self._repeat(part(55, 9))
        left = e1[:, :, None] + e2[:, None, :]
        i, j, k = np.nonzero(left <= self.slack)
        right = (e3[:, :, None] + e4[:, None, :]).reshape(-1, 4)
        row, choice = np.nonzero(left[i, j, k][:, None] + right[i] <= self.slack)
        i, j, k = i[row], j[row], k[row]
        return i, c1[i, j] | c2[i, k] << 23 | choice << 46


def copies(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``anchor, fp``: every fingerprint at every anchor in reach."""
    slack = -(-max_bits // 2)

    def run(batches):
        anchors = Anchors(slack)
        for batch in batches_of(batches):
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 500):
                index, anchor = anchors.of(fps[at : at + 500])
                yield record_batch(
                    {"anchor": (anchor, pa.int64()), "fp": (fps[at : at + 500][index], pa.int64())}
                )

    return over_batches(distinct.select("fp"), run, "anchor bigint, fp bigint")


def dealt(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``anchor, fp``: the copies, those of hot anchors dealt to pairs of blocks.

    A fingerprint is at an anchor once, so at most HOT_SHARE times the anchors of one
    fingerprint are hot, whatever the number of fingerprints: their list is broadcast.
    Groups of hot anchors are named by a hash; two that share a name are only compared more.
    """
    at_anchors = copies(distinct, max_bits)
    bound = F.lit(max(HOT_ROWS, distinct.count() // HOT_SHARE))
    hot = materialize(
        at_anchors.groupBy("anchor")
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > bound)
        .select("anchor", F.ceil(F.col("rows") * 2 / bound).alias("blocks")),
        "hot-anchors",
    )
    if hot.isEmpty():
        return at_anchors
    blocks = F.col("blocks")
    mine = F.pmod(F.xxhash64("fp"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    split = at_anchors.join(F.broadcast(hot), "anchor").select(
        "anchor", "fp", mine.alias("mine"), other.alias("other")
    )
    name = F.xxhash64("anchor", F.least("mine", "other"), F.greatest("mine", "other"))
    return at_anchors.join(F.broadcast(hot), "anchor", "left_anti").unionByName(
        split.select(name.alias("anchor"), "fp")
    )


def links_in_group(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a large group as all its links do.

    Grows one component after another; a fingerprint once reached is compared with the
    unreached ones only, so a dense group costs about its size, not its square.
    """
    rest, a, b = np.unique(fps), [], []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            some, front = front[:64], front[64:]
            near = distance(some[:, None], rest[None, :]) <= max_bits
            hit = near.any(axis=0)
            a.append(some[near[:, hit].argmax(axis=0)])
            b.append(rest[hit])
            front, rest = np.concatenate([front, rest[hit]]), rest[~hit]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def links_at_anchors(
    anchor: np.ndarray, fps: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by anchor."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    a, b = [], []
    for start, size in zip(starts[sizes > DENSE_GROUP], sizes[sizes > DENSE_GROUP]):
        left, right = links_in_group(fps[start : start + size], max_bits)
        a.append(left)
        b.append(right)
    small = np.repeat(sizes <= DENSE_GROUP, sizes)
    anchor, fps = anchor[small], fps[small]
    index, step = np.arange(len(anchor)), 1
    while len(index):
        index = index[index + step < len(anchor)]
        index = index[anchor[index] == anchor[index + step]]
        near = distance(fps[index], fps[index + step]) <= max_bits
        a.append(fps[index[near]])
        b.append(fps[index[near] + step])
        step += 1
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect what all links connect."""

    def run(batches):
        anchor, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        left, right, held = [], [], 0

        def found():
            a, b = forest(np.concatenate(left), np.concatenate(right))
            return record_batch({"a": (a, pa.int64()), "b": (b, pa.int64())})

        def take(anchor, fps):
            a, b = links_at_anchors(anchor, fps, max_bits)
            other = a != b
            left.append(a[other])
            right.append(b[other])
            return int(other.sum())

        for batch in batches_of(batches):
            anchor = np.concatenate([anchor, batch.column("anchor").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            if len(anchor) < 1 << 17 or anchor[0] == anchor[-1]:
                continue
            whole = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
            held += take(anchor[:whole], fps[:whole])
            anchor, fps = anchor[whole:], fps[whole:]
            if held > 1 << 20:
                yield found()
                left, right, held = [], [], 0
        if len(anchor):
            take(anchor, fps)
        if left:
            yield found()

    groups = dealt(distinct, max_bits).repartition("anchor").sortWithinPartitions("anchor")
    return over_batches(groups, run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Groups of documents whose fingerprints are linked, directly or by a chain.

    Returns one row per input row: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id of the group. Equal fingerprints are collapsed
    before any comparison, so exact copies cost one row. Null and blank texts have
    fingerprint zero and are linked like any other; fewer words than a shingle count as
    one shingle; repeated rows stay repeated; a null doc_id stays null and takes part in
    links, and a group with null ids only has a null component. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs, shingle_words, id_column, text), "fingerprints")
    distinct = materialize(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints"
    )
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    grouped = distinct.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    labels = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = grouped.join(labels, "root").select("fp", "component_id")
    return marked.join(labelled, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_column: str = "doc_id"
) -> DataFrame:
    """One document of each group: the row with the smallest id, all columns as they are.

    Rows that repeat an id are one document. Rows without an id cannot be named as a
    copy of anything and stay.
    """
    found = near_duplicates(docs, shingle_words, max_bits, id_column)
    name = unused(docs, "_kept_id")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    named = docs.where(F.col(id_column).isNotNull())
    first = named.join(
        kept, F.col(id_column).cast("bigint") == F.col(name), "left_semi"
    ).dropDuplicates([id_column])
    return first.unionByName(docs.where(F.col(id_column).isNull()))
