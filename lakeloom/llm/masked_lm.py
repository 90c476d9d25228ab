"""Masked pseudo-likelihood scoring with a bidirectional window network, in numpy.

Model. A token is predicted from ``SIDE`` tokens on either side: each place has its own
embedding of the vocabulary, the embeddings are added and go through tanh, and a softmax
in two steps (class of the word, then word in the class) gives the probability. The
network tells apart the corpus's most frequent words; all other words share hash buckets.
A bucket's probability is divided among its words by their counts in the whole corpus; a
word never seen counts as one occurrence. The table of all words and counts grows with the
corpus and stays a table: tasks remember the shares of its most frequent words, the others
are joined. A document's score is the sum of all its tokens' conditional
log-probabilities, each token masked in turn.

Training covers the whole corpus. Word counts come from all documents; then, in rounds
over disjoint shares of the documents that together are all of them, every task trains
on its own texts from the common parameters, and the parameters are averaged, weighted by
tokens, in a shuffle. The network's words, the remembered shares and one set of parameters
(some hundred thousand numbers each, whatever the corpus) reach the driver; the network is
of fixed size, the table of words is not. Averages are taken of whole numbers, so
they do not depend on the order of tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import batches_of, over_batches, record_batch, session, texts, word_runs
from lakeloom.session import materialize

CLASSES = CLASS_SIZE = 32
VOCABULARY = CLASSES * CLASS_SIZE  # ids: 0 is the edge of a text, then words, then buckets
BUCKETS = 256
WORDS = VOCABULARY - BUCKETS - 1
SIDE = 2
HIDDEN = 16
PLACES = [*range(-SIDE, 0), *range(1, SIDE + 1)]
BATCH = 8192
AT_ONCE = 8192  # small enough for a core's cache
RATE = 0.1
SCALE = 1e7  # parameters are averaged as whole numbers of this part
DISTINCT_AT_ONCE = 400_000
REMEMBERED = 1 << 17  # words whose shares tasks hold; all others are joined
SHARE_SCALE = 1e9  # logarithms of shares are added as whole numbers of this part

# Letters to lower case, all other ASCII but digits to blanks; bytes beyond ASCII are words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

SHAPES = {
    "near": (len(PLACES), VOCABULARY, HIDDEN),
    "near_bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "words": (CLASSES, HIDDEN, CLASS_SIZE),
    "word_bias": (CLASSES, CLASS_SIZE),
}


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: every word of the documents and how often it occurs."""

    def run(batches):
        counts: Counter = Counter()

        def counted():
            return record_batch(
                {
                    "word": (list(counts), pa.binary()),
                    "n": (list(counts.values()), pa.int64()),
                }
            )

        for batch in batches_of(batches):
            for text in texts(batch, "text"):
                for words in word_runs(text.translate(WORD_BYTES)):
                    counts.update(words)
                if len(counts) > DISTINCT_AT_ONCE:
                    yield counted()
                    counts = Counter()
        if counts:
            yield counted()

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return materialize(
        over_batches(rows, run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts",
    )


def vocabulary(
    docs: DataFrame, counted: DataFrame | None = None
) -> tuple[dict[bytes, int], np.ndarray]:
    """(id of each frequent word, counts of all ids), from all documents."""
    counted = word_counts(docs) if counted is None else counted
    top = counted.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    ids = {bytes(r["word"]): i + 1 for i, r in enumerate(top)}
    rest = (
        counted.groupBy((F.crc32("word") % BUCKETS).alias("bucket")).agg(F.sum("n").alias("n"))
    ).collect()
    counts = np.zeros(VOCABULARY)
    for r in rest:
        counts[VOCABULARY - BUCKETS + r["bucket"]] = r["n"]
    for r in top:
        counts[ids[bytes(r["word"])]] = r["n"]
        counts[VOCABULARY - BUCKETS + zlib.crc32(bytes(r["word"])) % BUCKETS] -= r["n"]
    return ids, counts


def shares(counted: DataFrame, ids: dict[bytes, int]) -> tuple[DataFrame, np.ndarray]:
    """``word, n, share`` of the words in buckets, and the share of a word never seen, by bucket.

    A share is the logarithm of the word's part of its bucket, in ``SHARE_SCALE`` parts.
    """
    known = counted.sparkSession.createDataFrame([(bytearray(w),) for w in ids], "word binary")
    bucket = (F.crc32("word") % BUCKETS).cast("int")
    rest = counted.join(F.broadcast(known), "word", "left_anti").withColumn("bucket", bucket)
    total = np.zeros(BUCKETS)
    for r in rest.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    all_ = F.get(F.lit((total + 1).tolist()), F.col("bucket"))
    share = F.round(F.log(F.col("n") / all_) * SHARE_SCALE).cast("bigint")
    unseen = np.rint(-np.log(total + 1) * SHARE_SCALE).astype(np.int64)
    return rest.select("word", "n", share.alias("share")), unseen


def start(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small random embeddings; the biases give the words' own frequencies."""
    random = np.random.default_rng(7)
    parameters = {
        name: random.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()
    }
    share = np.log((counts + 0.1) / (counts.sum() + 0.1 * len(counts))).reshape(CLASSES, CLASS_SIZE)
    by_class = np.log(np.exp(share).sum(axis=1))
    parameters["class_bias"] = by_class.astype(np.float32)
    parameters["word_bias"] = (share - by_class[:, None]).astype(np.float32)
    parameters["near_bias"] = np.zeros(HIDDEN, np.float32)
    return parameters


class Network:
    def __init__(self, ids: dict[bytes, int], parameters: dict[str, np.ndarray]):
        self.ids, self.p = ids, parameters

    def tokens(self, text: bytes) -> np.ndarray:
        known, crc, first = self.ids.get, zlib.crc32, VOCABULARY - BUCKETS
        runs = [
            np.array([known(w) or first + crc(w) % BUCKETS for w in words], np.int32)
            for words in word_runs(text.translate(WORD_BYTES))
        ]
        return np.concatenate([np.empty(0, np.int32), *runs])

    def joined(self, batch: list[bytes]):
        """(tokens with edges between the texts, tokens' places, text of each token)."""
        found = [self.tokens(t) for t in batch]
        edge = np.zeros(SIDE, np.int32)
        line = np.concatenate([edge, *[x for f in found for x in (f, edge)]])
        text_of = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return line, np.arange(len(text_of)) + SIDE * (text_of + 1), text_of

    def hidden(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(self.p["near_bias"], (len(at), HIDDEN)).copy()
        for j, place in enumerate(PLACES):
            total += self.p["near"][j][line[at + place]]
        return np.tanh(total)

    def logits(self, h: np.ndarray, kind: int | None = None) -> np.ndarray:
        """Of the classes, or of the words of one; a column a token."""
        if kind is None:
            return self.p["classes"].T @ h.T + self.p["class_bias"][:, None]
        return self.p["words"][kind].T @ h.T + self.p["word_bias"][kind][:, None]

    def log_probabilities(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at))
        for k in range(0, len(at), AT_ONCE):
            some = at[k : k + AT_ONCE]
            h, target = self.hidden(line, some), line[some]
            kind = target // CLASS_SIZE
            value = log_softmax_at(self.logits(h), kind)
            order = np.argsort(kind, kind="stable")
            cuts = np.searchsorted(kind[order], np.arange(CLASSES + 1))
            for c in np.unique(kind):
                rows = order[cuts[c] : cuts[c + 1]]
                value[rows] += log_softmax_at(self.logits(h[rows], c), target[rows] % CLASS_SIZE)
            out[k : k + AT_ONCE] = value
        return out

    def train(self, line: np.ndarray, at: np.ndarray, squares: dict[str, np.ndarray]) -> None:
        """One pass of Adagrad over the tokens, in an order that mixes the texts."""
        for some in np.array_split(at, max(1, len(at) // BATCH)):
            h, target = self.hidden(line, some), line[some]
            kind, rate = target // CLASS_SIZE, 1 / len(some)
            grad = softmax(self.logits(h))
            grad[kind, np.arange(len(some))] -= 1
            back = (self.p["classes"] @ grad).T.copy()
            steps = {"classes": (grad @ h).T * rate, "class_bias": grad.sum(axis=1) * rate}
            words = np.zeros(SHAPES["words"], np.float32)
            biases = np.zeros(SHAPES["word_bias"], np.float32)
            order = np.argsort(kind, kind="stable")
            cuts = np.searchsorted(kind[order], np.arange(CLASSES + 1))
            for c in np.unique(kind):
                rows = order[cuts[c] : cuts[c + 1]]
                grad = softmax(self.logits(h[rows], c))
                grad[target[rows] % CLASS_SIZE, np.arange(len(rows))] -= 1
                back[rows] += (self.p["words"][c] @ grad).T
                words[c] = (grad @ h[rows]).T * rate
                biases[c] = grad.sum(axis=1) * rate
            steps |= {"words": words, "word_bias": biases}
            back *= (1 - h * h) * rate
            steps["near_bias"] = back.sum(axis=0)
            near = np.empty(SHAPES["near"], np.float32)
            for j, place in enumerate(PLACES):
                column = line[some + place]
                for d in range(HIDDEN):
                    near[j, :, d] = np.bincount(column, back[:, d], VOCABULARY)
            steps["near"] = near
            for name, step in steps.items():
                squares[name] += step * step
                self.p[name] -= RATE * step / (np.sqrt(squares[name]) + 1e-6)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


def log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=0)
    return logits[at, np.arange(len(at))] - np.log(np.exp(logits).sum(axis=0))


def one_round(
    docs: DataFrame, ids: dict[bytes, int], parameters: dict[str, np.ndarray]
) -> dict[str, np.ndarray]:
    """The average of what the tasks learn from their texts."""
    spark = session(docs)
    shared = spark.sparkContext.broadcast((ids, parameters))

    def run(batches):
        known, first = shared.value
        network = Network(known, {k: v.copy() for k, v in first.items()})
        squares = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        tokens = 0
        for batch in batches_of(batches):
            line, at, _ = network.joined(texts(batch, "text"))
            if len(at):
                tokens += len(at)
                random = np.random.default_rng(len(at))
                for k in range(0, len(at), 1 << 20):
                    network.train(line, random.permutation(at[k : k + (1 << 20)]), squares)
        if tokens:
            flat = np.concatenate([network.p[k].ravel() for k in SHAPES]).astype(np.float64)
            yield record_batch(
                {
                    "place": (np.arange(len(flat) + 1), pa.int64()),
                    "value": (np.r_[np.rint(flat * SCALE) * tokens, tokens], pa.float64()),
                }
            )

    sums = (
        over_batches(docs.select("text"), run, "place bigint, value double")
        .groupBy("place")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("double").alias("value"))
        .collect()
    )
    if not sums:
        return parameters
    flat = np.empty(len(sums))
    for place, value in sums:
        flat[place] = value
    flat = flat[:-1] / flat[-1] / SCALE
    result, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        result[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return result


def fit(
    docs: DataFrame,
    rounds: int = 2,
    id_column: str = "doc_id",
    text: str = "text",
    counted: DataFrame | None = None,
) -> tuple[dict[bytes, int], dict[str, np.ndarray]]:
    """(vocabulary, parameters) learnt from all documents, each used in one round."""
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(rounds)).alias("share"),
        F.col(text).cast("string").alias("text"),
    )
    ids, counts = vocabulary(rows, counted)
    parameters = start(counts)
    for k in range(rounds):
        parameters = one_round(rows.where(F.col("share") == k), ids, parameters)
    return ids, parameters


def score(
    docs: DataFrame,
    ids: dict[bytes, int],
    parameters: dict[str, np.ndarray],
    id_column: str = "doc_id",
    text: str = "text",
    counted: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, n_tokens, pseudo_log_likelihood, mean_log_probability`` of every row.

    A text without words (null, empty) has no tokens, sum 0 and a null mean. Texts are
    scored whole, whatever their length; repeated rows stay; other columns are ignored.

    ``counted`` is the table of ``word_counts``: with it a word in a bucket has its share of
    the bucket's probability, without it the whole bucket's.
    """
    spark = session(docs)
    table = unseen = None
    remembered: dict[bytes, int] = {}
    if counted is not None:
        table, unseen = shares(counted, ids)
        table = materialize(table, "shares")
        frequent = table.orderBy(F.desc("n"), "word").limit(REMEMBERED).toArrow()
        words, values = frequent["word"].to_pylist(), frequent["share"].to_pylist()
        remembered = dict(zip(words, values)) | dict.fromkeys(ids, 0)
    shared = spark.sparkContext.broadcast((ids, parameters, remembered))
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    if counted is not None:
        return with_shares(rows, shared, table, unseen)

    def run(batches):
        network = Network(*shared.value[:2])
        for batch in batches_of(batches):
            line, at, text_of = network.joined(texts(batch, "text"))
            n = np.bincount(text_of, minlength=batch.num_rows)
            total = np.bincount(text_of, network.log_probabilities(line, at), batch.num_rows)
            mean = total / np.maximum(n, 1)
            yield record_batch(
                {
                    "doc_id": (batch.column("doc_id"), pa.int64()),
                    "n_tokens": (n, pa.int64()),
                    "pseudo_log_likelihood": (total, pa.float64()),
                    "mean_log_probability": (pa.array(mean, mask=n == 0), pa.float64()),
                }
            )

    return over_batches(
        rows,
        run,
        "doc_id bigint, n_tokens bigint, pseudo_log_likelihood double, mean_log_probability double",
    )


def with_shares(rows: DataFrame, shared, table: DataFrame, unseen: np.ndarray) -> DataFrame:
    """The scores with the words' shares of their buckets.

    Each row is scored once and written with the words that tasks do not remember; their
    shares are joined by word and added up by row.
    """

    def run(batches):
        ids, parameters, remembered = shared.value
        network, share_of = Network(ids, parameters), remembered.get
        for batch in batches_of(batches):
            found = texts(batch, "text")
            line, at, text_of = network.joined(found)
            known, others = [], []
            for text in found:
                total, rest = 0, []
                for words in word_runs(text.translate(WORD_BYTES)):
                    values = list(map(share_of, words))
                    rest += [w for w, v in zip(words, values) if v is None]
                    total += sum(filter(None, values))
                known.append(total)
                others.append(rest)
            yield record_batch(
                {
                    "row": (batch.column("row"), pa.int64()),
                    "doc_id": (batch.column("doc_id"), pa.int64()),
                    "n_tokens": (np.bincount(text_of, minlength=batch.num_rows), pa.int64()),
                    "total": (
                        np.bincount(text_of, network.log_probabilities(line, at), batch.num_rows),
                        pa.float64(),
                    ),
                    "known": (known, pa.int64()),
                    "others": (others, pa.list_(pa.binary())),
                }
            )

    scored = materialize(
        over_batches(
            rows.withColumn("row", F.monotonically_increasing_id()),
            run,
            "row bigint, doc_id bigint, n_tokens bigint, total double, known bigint, "
            "others array<binary>",
        ),
        "scored",
    )
    bucket = (F.crc32("word") % BUCKETS).cast("int")
    added = (
        scored.select("row", F.explode("others").alias("word"))
        .join(table.select("word", "share"), "word", "left")
        .withColumn("share", F.coalesce("share", F.get(F.lit(unseen.tolist()), bucket)))
        .groupBy("row")
        .agg(F.sum("share").alias("added"))
    )
    total = F.col("total") + (F.col("known") + F.coalesce("added", F.lit(0))) / SHARE_SCALE
    return (
        scored.drop("others")
        .join(added, "row", "left")
        .select("doc_id", "n_tokens", total.alias("pseudo_log_likelihood"))
        .withColumn(
            "mean_log_probability",
            F.when(F.col("n_tokens") > 0, F.col("pseudo_log_likelihood") / F.col("n_tokens")),
        )
    )
