"""Phrase collocations by vertical partitioning of a depth-truncated suffix tree.

Counts. Every place of a word starts a suffix, cut after ``DEPTH`` words, at the end of its
piece, and before a word that is too rare to be part of a candidate. How often a phrase
occurs is the number of suffixes below its node of the tree of all suffixes, overlaps
included.

Vertical partitioning. The tree is not built as a whole. Suffixes fall into buckets by their
first word; the load of every bucket is counted over the whole corpus, and a bucket that
is too large for half the memory budget is parted again by two words, then three, then
four. Buckets are packed into groups of at most about one budget. One shuffle deals the
suffixes to their groups, equal ones of a batch as one with a count, and each group builds
its subtrees alone: sorted suffixes are the leaves, borders between different prefixes the
nodes, and a node's count the total of its leaves. Nodes above the words a bucket was
parted by lie in several groups; their parts are added up afterwards.

Words are 64-bit hashes. No two words of a language may share one: that is checked over all
words of the corpus, and another seed is taken if it fails. Rare words are found by a
bitmap of fixed size, in which a collision only lets a suffix be longer than it must be.

Bounds. The driver gets one number a bucket (at most 2^22) and the bitmap (2^26 bits), both
broadcast. A group holds at most one and a half budgets of suffixes. A batch holds
``BATCH_BYTES`` of text or one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.shared import batches_of, gathered, over_batches, record_batch, session
from lakeloom.llm.words import kinds, words_of
from lakeloom.session import materialize

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD = kinds([b for b in range(256) if b not in b"\x20\x09" + BREAKS], BREAKS)
DEPTH = 4
BUDGET = 1 << 20  # suffixes in a group
GROUPS_A_PARTITION = 2
BATCH_BYTES = 8 << 20
MARK_BITS = 26
BUCKET_BITS = 16, 22
SEEDS = 8
SALTS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd; any odd number with well-spread bits does

SUFFIX = np.dtype([(f"w{d}", "<u8") for d in range(1, DEPTH + 1)] + [("n", "<u8")])


# --- words of a batch ---------------------------------------------------------------


def by_language(batches, seed: int):
    """(language, codes, pieces, hashes of the codes, dictionary) of runs of texts."""
    for batch in gathered(batches, "text", BATCH_BYTES):
        order = pa.compute.sort_indices(batch, [("lang", "ascending")])
        batch = batch.take(order)
        found = words_of(batch.column("text"), WORD)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(w, seed) for w in found.dictionary.to_pylist()),
            np.uint64,
            len(found.dictionary),
        )
        langs = batch.column("lang").dictionary_encode()
        number = langs.indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        ends = np.searchsorted(found.rows, np.r_[starts[1:], len(number)])
        names = langs.dictionary.to_pylist()
        for start, a, b in zip(starts, np.r_[0, ends[:-1]], ends):
            lang = names[number[start]]
            yield lang, found.codes[a:b], found.pieces[a:b], hashes, found.dictionary


def rows_of(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )


def counted_words(rows: DataFrame, seed: int) -> DataFrame:
    """``lang, id, word, a``: how often each word of a language occurs."""

    def run(batches):
        for lang, codes, _, hashes, words in by_language(batches, seed):
            n = np.bincount(codes, minlength=len(words))
            seen = np.flatnonzero(n)
            yield record_batch(
                {
                    "lang": ([lang] * len(seen), pa.string()),
                    "id": (hashes[seen].view(np.int64), pa.int64()),
                    "word": (words.take(pa.array(seen)).cast(pa.binary()).cast(pa.string()), None),
                    "a": (n[seen], pa.int64()),
                }
            )

    found = over_batches(rows, run, "lang string, id bigint, word string, a bigint")
    return found.groupBy("lang", "id", "word").agg(F.sum("a").alias("a"))


def words_with_ids(rows: DataFrame, first_seed: int = 0) -> tuple[DataFrame, int]:
    """All words with ids that tell the words of a language apart, and the ids' seed."""
    for seed in range(first_seed, first_seed + SEEDS):
        words = materialize(counted_words(rows, seed), "words")
        shared = words.groupBy("lang", "id").count().where("count > 1 or id = 0")
        if not shared.limit(1).count():
            return words, seed
    raise RuntimeError(f"words share hashes with {SEEDS} seeds")


# --- suffixes -----------------------------------------------------------------------


def marks_of(words: DataFrame, least: int) -> bytes:
    """Bitmap of the leading bits of the ids of words that are frequent in some language.

    It is compressed, as most of it is zero until a corpus is very large.
    """
    bit = F.shiftrightunsigned("id", 64 - MARK_BITS)
    found = (
        words.where(F.col("a") >= least)
        .groupBy(F.shiftright(bit, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(id, {64 - MARK_BITS}) & 63 as int))")).alias("bits"))
        .toArrow()
    )
    marks = np.zeros(1 << MARK_BITS - 6, np.uint64)
    marks[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return pa.compress(marks.tobytes(), codec="zstd", asbytes=True)


def marked(marks: bytes) -> np.ndarray:
    """The bitmap as 64-bit words."""
    size = 1 << MARK_BITS - 3
    return np.frombuffer(pa.decompress(marks, size, codec="zstd", asbytes=True), np.uint64)


def suffixes(codes, pieces, hashes, marks) -> np.ndarray:
    """Distinct suffixes of two words or more, with counts; 0 stands for no word."""
    n = len(codes)
    bit = hashes >> np.uint64(64 - MARK_BITS)
    words = marks[(bit >> np.uint64(6)).astype(np.int64)]
    frequent = (words >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)[codes]
    goes_on = frequent.copy()
    packed = []
    code = codes.astype(np.uint64) + np.uint64(1)
    for d in range(DEPTH):
        here = np.zeros(n, np.uint64)
        if d < n:
            goes_on = goes_on[: n - d] & frequent[d:] & (pieces[d:] == pieces[: n - d])
            here[: n - d][goes_on] = code[d:][goes_on]
        else:
            goes_on = goes_on[:0]
        packed.append(here)
    whole = packed[1] > 0
    first = (packed[0] << np.uint64(32) | packed[1])[whole]
    second = (packed[2] << np.uint64(32) | packed[3])[whole]
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    starts = np.flatnonzero(
        np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])][: len(first)]
    )
    found = np.empty(len(starts), SUFFIX)
    ids = np.r_[np.uint64(0), hashes]
    low = np.uint64((1 << 32) - 1)
    found["w1"], found["w2"] = ids[(first >> np.uint64(32))[starts]], ids[(first & low)[starts]]
    found["w3"], found["w4"] = ids[(second >> np.uint64(32))[starts]], ids[(second & low)[starts]]
    found["n"] = np.diff(np.r_[starts, len(first)])
    return found


class Groups:
    """Which group a suffix belongs to: buckets by one word, and more where these are hot."""

    def __init__(self, bits: int, budget: int):
        self.bits, self.budget = bits, budget
        self.loads: list[np.ndarray] = []
        self.group: list[np.ndarray] = []

    def hot(self, depth: int) -> np.ndarray:
        """Buckets by ``depth`` words that are parted by one more word."""
        if depth == DEPTH:
            return np.zeros(1 << self.bits, bool)
        return self.loads[depth - 1] > self.budget // 2

    def buckets(self, found: np.ndarray, depth: int) -> np.ndarray:
        mixed = found["w1"]
        for d in range(2, depth + 1):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX + found[f"w{d}"]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def below(self, found: np.ndarray) -> np.ndarray:
        """Suffixes that are parted by more words than loads are known for so far."""
        for depth in range(1, len(self.loads) + 1):
            found = found[self.hot(depth)[self.buckets(found, depth)]]
        return found

    def pack(self) -> None:
        """Numbers buckets by group, each group about one budget."""
        base = 0
        for depth, loads in enumerate(self.loads, 1):
            kept = np.where(self.hot(depth), 0, loads)
            group = base + (np.cumsum(kept) - kept) // self.budget
            self.group.append(group.astype(np.int32))
            base = int(group[-1]) + 1

    def of(self, found: np.ndarray) -> np.ndarray:
        result = np.empty(len(found), np.int32)
        rest = np.arange(len(found))
        for depth in range(1, len(self.loads) + 1):
            bucket = self.buckets(found[rest], depth)
            result[rest] = self.group[depth - 1][bucket]
            rest = rest[self.hot(depth)[bucket]]
        return result

    def spread(self, nodes: np.ndarray, depth: int) -> np.ndarray:
        """Whether the suffixes below a node of so many words lie in several groups."""
        result = np.zeros(len(nodes), bool)
        rest = np.arange(len(nodes))
        for d in range(1, min(depth, len(self.loads)) + 1):
            rest = rest[self.hot(d)[self.buckets(nodes[rest], d)]]
        if depth <= len(self.loads):
            result[rest] = True
        return result


def bucket_loads(rows: DataFrame, seed: int, shared) -> np.ndarray:
    """Suffixes in each bucket by one word more than loads are known for."""
    bits = shared.value[1].bits

    def run(batches):
        marks, groups = marked(shared.value[0]), shared.value[1]
        depth = len(groups.loads) + 1
        loads = np.zeros(1 << bits, np.int64)
        for _, codes, pieces, hashes, _ in by_language(batches, seed):
            found = groups.below(suffixes(codes, pieces, hashes, marks))
            np.add.at(loads, groups.buckets(found, depth), found["n"].astype(np.int64))
        at = np.flatnonzero(loads)
        yield record_batch({"bucket": (at, pa.int64()), "n": (loads[at], pa.int64())})

    found = over_batches(rows, run, "bucket bigint, n bigint")
    return dense(found.groupBy("bucket").agg(F.sum("n").alias("n")), bits)


def dense(loads: DataFrame, bits: int) -> np.ndarray:
    found = loads.toArrow()
    result = np.zeros(1 << bits, np.int64)
    result[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return result


def partitioned(
    rows: DataFrame, words: DataFrame, seed: int, marks: bytes, budget: int
) -> Groups:
    """The groups of all suffixes; a pass over the texts for each level that is parted."""
    spark = rows.sparkSession
    total = words.agg(F.sum("a")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) * GROUPS_A_PARTITION
    budget = max(1, min(budget, total // partitions))
    bits = min(max(int(np.log2(16 * total / budget + 1)) + 1, BUCKET_BITS[0]), BUCKET_BITS[1])
    groups = Groups(bits, budget)
    bucket = F.shiftrightunsigned("id", 64 - bits).alias("bucket")
    groups.loads.append(dense(words.groupBy(bucket).agg(F.sum("a").alias("n")), bits))
    while len(groups.loads) < DEPTH and groups.hot(len(groups.loads)).any():
        shared = spark.sparkContext.broadcast((marks, groups))
        groups.loads.append(bucket_loads(rows, seed, shared))
    groups.pack()
    return groups


# --- subtrees -----------------------------------------------------------------------


def dealt(rows: DataFrame, seed: int, shared) -> DataFrame:
    """``part, lang, n, suffixes``: each batch's suffixes, compressed, by group."""

    def run(batches):
        marks, groups = marked(shared.value[0]), shared.value[1]
        for lang, codes, pieces, hashes, _ in by_language(batches, seed):
            found = suffixes(codes, pieces, hashes, marks)
            group = groups.of(found)
            order = np.argsort(group, kind="stable")
            found, group = found[order], group[order]
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
            ends = np.r_[starts[1:], len(group)][: len(starts)]
            yield record_batch(
                {
                    "part": (group[starts], pa.int32()),
                    "lang": ([lang] * len(starts), pa.string()),
                    "n": (ends - starts, pa.int64()),
                    "suffixes": ([packed(found[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                }
            )

    return over_batches(rows, run, "part int, lang string, n bigint, suffixes binary")


def packed(found: np.ndarray) -> bytes:
    columns = b"".join(found[f].tobytes() for f in SUFFIX.names)
    return pa.compress(columns, codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    columns = pa.decompress(data, n * SUFFIX.itemsize, codec="zstd", asbytes=True)
    found = np.empty(n, SUFFIX)
    for k, f in enumerate(SUFFIX.names):
        found[f] = np.frombuffer(columns, "<u8", n, k * n * 8)
    return found


def subtree(found: np.ndarray, groups: Groups, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, counts) of the nodes of two words and more in one group and language.

    Nodes below ``least`` are left out unless other groups hold a part of them.
    """
    words = [found[f"w{d}"] for d in range(1, DEPTH + 1)]
    order = np.lexsort(words[::-1])
    found = found[order]
    differs = np.zeros(len(found), bool)
    differs[:1] = True
    nodes, counts = [], []
    for depth in range(1, DEPTH + 1):
        word = found[f"w{depth}"]
        differs[1:] |= word[1:] != word[:-1]
        starts = np.flatnonzero(differs)
        if depth == 1 or not len(starts):
            continue
        total = np.add.reduceat(found["n"], starts).astype(np.int64)
        here = found[starts]
        wanted = (here[f"w{depth}"] != 0) & ((total >= least) | groups.spread(here, depth))
        line = np.zeros((int(wanted.sum()), DEPTH), np.uint64)
        for d in range(1, depth + 1):
            line[:, d - 1] = here[f"w{d}"][wanted]
        nodes.append(line)
        counts.append(total[wanted])
    if not nodes:
        return np.zeros((0, DEPTH), np.uint64), np.zeros(0, np.int64)
    return np.concatenate(nodes), np.concatenate(counts)


def phrase_counts(rows: DataFrame, words: DataFrame, seed: int, least: int, budget: int) -> DataFrame:
    """``lang, w, a``: all phrases of one to four words that occur ``least`` times.

    ``w`` lists the ids of the words.
    """
    marks = marks_of(words, least)
    groups = partitioned(rows, words, seed, marks, budget)
    shared = rows.sparkSession.sparkContext.broadcast((marks, groups))

    def run(batches):
        groups = shared.value[1]
        held, of = [], None

        def emit():
            nodes, counts = subtree(np.concatenate(held), groups, least)
            ids = [pa.array(c) for c in nodes.view(np.int64).T]
            return pa.RecordBatch.from_arrays(
                [pa.array([of[1]] * len(counts), pa.string()), *ids, pa.array(counts)],
                names=["lang", "w1", "w2", "w3", "w4", "a"],
            )

        for batch in batches_of(batches):
            columns = (batch.column(c) for c in ("part", "lang", "n", "suffixes"))
            for part, lang, n, data in zip(*(c.to_pylist() for c in columns)):
                if of != (part, lang):
                    if held:
                        yield emit()
                    held, of = [], (part, lang)
                held.append(unpacked(data, n))
        if held:
            yield emit()

    parts = dealt(rows, seed, shared).repartition("part").sortWithinPartitions("part", "lang")
    schema = "lang string, w1 bigint, w2 bigint, w3 bigint, w4 bigint, a bigint"
    longer = (
        over_batches(parts, run, schema)
        .groupBy("lang", "w1", "w2", "w3", "w4")
        .agg(F.sum("a").alias("a"))
        .where(F.col("a") >= least)
        .select("lang", F.expr("filter(array(w1, w2, w3, w4), x -> x <> 0)").alias("w"), "a")
    )
    single = words.where(F.col("a") >= least).select("lang", F.array("id").alias("w"), "a")
    return materialize(longer.unionByName(single), "phrases")


# --- scores -------------------------------------------------------------------------


def scored(counts: DataFrame, scale: int) -> DataFrame:
    """``lang, w, a, score, l, r``: every candidate at its lowest-scoring cut."""
    cut = counts.where("size(w) > 1").select(
        "lang", "w", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k")
    )
    first = counts.select("lang", F.col("w").alias("first"), F.col("a").alias("l"))
    rest = counts.select("lang", F.col("w").alias("rest"), F.col("a").alias("r"))
    score = F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)")
    return (
        cut.withColumn("first", F.expr("slice(w, 1, k)"))
        .withColumn("rest", F.expr("slice(w, k + 1, size(w))"))
        .join(first, ["lang", "first"])
        .join(rest, ["lang", "rest"])
        .groupBy("lang", "w", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
        .select("lang", "w", "a", "best.score", "best.l", "best.r")
    )


def outermost(candidates: DataFrame, counts: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Candidates that no longer one holds almost as often."""
    inner = (
        counts.where("size(w) > 2")
        .withColumn("length", F.explode(F.expr("sequence(2, size(w) - 1)")))
        .withColumn("start", F.explode(F.expr("sequence(1, size(w) - length + 1)")))
        .groupBy("lang", F.expr("slice(w, start, length)").alias("w"))
        .agg(F.max("a").alias("longer"))
    )
    wide = "cast({} as decimal(19,0)) * {}"
    held = F.expr(f"{wide.format('longer', share[1])} >= {wide.format('a', share[0])}")
    joined = candidates.join(inner, ["lang", "w"], "left")
    return joined.where(F.col("longer").isNull() | ~held).drop("longer")


def collocations(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    scale: int = 2_000_000,
    share: tuple[int, int] = (80, 100),
    lang: str = "lang",
    text: str = "text",
    budget: int = BUDGET,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and these
    into words at blanks and tabs. A phrase of two to four words of one piece that occurs
    ``a >= least`` times is a candidate; of its cuts into a first part (``l`` times) and a
    rest (``r`` times) the one of the lowest ``floor(scale a / (l + r))`` counts, of equal
    ones the first. It is dropped if a longer candidate holds it and occurs at least
    ``share`` as often. The first ``top`` by score, then ``a``, then phrase (bytes) are
    returned; ``n`` counts the language's words. A null language is ``und`` (and shares it
    with that label); null, empty and blank texts have no words; repeated rows count
    again; other columns are ignored; no documents give no rows.
    """
    session(docs)
    rows = rows_of(docs, lang, text)
    words, seed = words_with_ids(rows)
    counts = phrase_counts(rows, words, seed, least, budget)
    kept = outermost(scored(counts, scale), counts, share)
    salt = F.pmod(F.xxhash64("w"), F.lit(SALTS)).alias("salt")
    best = [F.col("score").desc(), F.col("a").desc()]
    in_salt = Window.partitionBy("lang", "salt").orderBy(*best)
    # Every row that can be among the first has one of these ranks; ties stay.
    kept = kept.select("*", salt).withColumn("place", F.rank().over(in_salt)).where(F.col("place") <= top)
    kept = materialize(kept.drop("place"), "collocations")
    named = (
        kept.select("lang", "w", F.posexplode("w").alias("at", "id"))
        .join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "w")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("named"))
        .select("lang", "w", F.array_join("named.word", " ").alias("phrase"))
    )
    ordered = [*best, F.col("phrase").asc()]
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    first = (
        kept.join(named, ["lang", "w"])
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*ordered)))
        .where(F.col("place") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*ordered)).cast("bigint"))
        .where(F.col("rank") <= top)
    )
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
