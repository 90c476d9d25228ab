"""Language identification by hyperdimensional letter-trigram profiles.

Method. Every letter has a random vector of +1 and -1. A trigram's vector binds its three
letters: the first is rotated by two places, the second by one, and all are multiplied.
A text's vector bundles (adds) the vectors of its trigrams; a language's prototype is the
sum of its training texts' unit vectors. The prediction is the prototype with the largest
cosine. Runs of characters that are no letters count as one blank.

Scale. Documents become vectors of one byte a dimension in one pass, which is written
once; prototypes are sums of them, added up in each task before the shuffle. Only the
prototypes (languages x dimensions) reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import batches_of, nested, over_batches, record_batch
from lakeloom.session import materialize

DIMENSIONS = 512
SYMBOLS = 256  # blank, then letters; rare letters of large alphabets share a vector
CHARS_AT_ONCE = 1 << 18
MAX_LANGUAGES = 10_000  # bound on what the driver and each task hold: 512 numbers each
UNDETERMINED = "und"


class Profiler:
    """Makes the bundled vector of a text."""

    def __init__(self):
        # Symbol of each code point of the first plane: 0 for no letter, else by lower case.
        self.symbol_of_code = np.zeros(1 << 16, np.uint8)
        for code in range(1 << 16):
            char = chr(code)
            if char.isalpha():
                self.symbol_of_code[code] = self.letter(ord(char.lower()[0]))
        random = np.random.default_rng(20_240_229)
        plain = random.choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
        self.vectors = np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain

    @staticmethod
    def letter(code: int) -> int:
        if 97 <= code <= 122:
            return code - 96
        return 27 + code * 2654435761 // 256 % (SYMBOLS - 27)

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        found = self.symbol_of_code[np.minimum(codes, 0xFFFF)]
        for i in np.flatnonzero(codes > 0xFFFF):
            char = chr(codes[i])
            found[i] = self.letter(ord(char.lower()[0])) if char.isalpha() else 0
        return found

    def profile(self, text: str) -> np.ndarray | None:
        """The sum of the trigrams' vectors, or None if the text has no letter."""
        total, kept, letters = np.zeros(DIMENSIONS), np.zeros(1, np.uint8), False
        first, second, third = self.vectors
        for at in range(0, len(text) + 1, CHARS_AT_ONCE):
            found = self.symbols(text[at : at + CHARS_AT_ONCE])
            if at + CHARS_AT_ONCE > len(text):
                found = np.append(found, np.uint8(0))
            letters = letters or bool(found.any())
            before = np.r_[kept[-1], found[:-1]]
            kept = np.concatenate([kept[-2:], found[(found != 0) | (before != 0)]])
            if len(kept) < 3:
                continue
            codes = kept[:-2].astype(np.int32) << 16 | kept[1:-1].astype(np.int32) << 8 | kept[2:]
            grams, counts = np.unique(codes, return_counts=True)
            for i in range(0, len(grams), 4096):
                g, c = grams[i : i + 4096], counts[i : i + 4096]
                bound = first[g >> 16] * second[g >> 8 & 255] * third[g & 255]
                total += c.astype(np.float32) @ bound.astype(np.float32)
        return total if letters else None


def quantised(vector: np.ndarray | None) -> bytes | None:
    """One signed byte a dimension; the direction is what counts."""
    if vector is None:
        return None
    return np.rint(vector * (127 / max(np.abs(vector).max(), 1e-9))).astype(np.int8).tobytes()


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have a vector, unit vectors of those)."""
    values = column.to_pylist()
    there = np.array([v is not None for v in values], bool)
    joined = np.frombuffer(b"".join(v for v in values if v is not None), np.int8)
    return there, unit(joined.reshape(-1, DIMENSIONS).astype(np.float64))


def profiles(rows: DataFrame, *path: str) -> DataFrame:
    """The rows with ``vector`` (null without letters) of the text at ``path``.

    A text that is a column of its own is left out of the result.
    """
    alone = path[0] if len(path) == 1 else None
    schema = (rows.drop(alone) if alone else rows.select("*")).schema.add("vector", "binary")

    def run(batches):
        profiler = Profiler()
        for batch in batches_of(batches):
            vectors = [
                quantised(profiler.profile(t)) if t else None
                for t in nested(batch, path).to_pylist()
            ]
            kept = [n for n in batch.schema.names if n != alone]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(vectors, pa.binary())],
                names=[*kept, "vector"],
            )

    return over_batches(rows, run, schema)


def prototypes(vectors: DataFrame, label: str) -> dict[str, np.ndarray]:
    """Unit prototype of each label, from rows with ``vector`` and a label.

    Each task sums its vectors before the shuffle, so a label with most of the rows
    brings one row a dimension and task.
    """

    def sums(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches_of(batches):
            there, units = unpacked(batch.column("vector"))
            names = np.array(batch.column(label).to_pylist(), object)[there]
            for name in set(names):
                held[name] = held.get(name, 0) + units[names == name].sum(axis=0)
        for name, total in held.items():
            yield record_batch(
                {
                    "label": ([name] * DIMENSIONS, pa.string()),
                    "dimension": (np.arange(DIMENSIONS), pa.int64()),
                    "value": (np.rint(total * 1e9), pa.float64()),
                }
            )

    training = vectors.where(F.col(label).isNotNull() & F.col("vector").isNotNull())
    # Whole numbers are added, so that the order of the tasks does not show in the sum.
    added = (
        over_batches(
            training.select(F.col(label), "vector"),
            sums,
            "label string, dimension long, value double",
        )
        .groupBy("label", "dimension")
        .agg(F.sum(F.col("value").cast("decimal(28,0)")).cast("double").alias("value"))
    )
    rows = added.limit((MAX_LANGUAGES + 1) * DIMENSIONS).collect()
    if len(rows) > MAX_LANGUAGES * DIMENSIONS:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    found: dict[str, np.ndarray] = {}
    for name, dimension, value in rows:
        found.setdefault(name, np.zeros(DIMENSIONS))[dimension] = value
    return {name: unit(found[name]) for name in sorted(found)}


def predictions(vectors: DataFrame, known: dict[str, np.ndarray]) -> DataFrame:
    """The rows' other columns, ``lang_pred`` and ``score``."""
    names = np.array([*known, UNDETERMINED], object)
    matrix = np.array(list(known.values())).reshape(-1, DIMENSIONS)

    def run(batches):
        for batch in batches_of(batches):
            there, units = unpacked(batch.column("vector"))
            best, score = np.full(len(there), len(names) - 1), np.zeros(len(there))
            if len(matrix) and there.any():
                cosine = units @ matrix.T
                best[there] = cosine.argmax(axis=1)  # ties: the first name in order
                score[there] = np.clip(cosine.max(axis=1), 0, 1)
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "vector"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names[best], pa.string()), pa.array(score)],
                names=[n for n in batch.schema.names if n != "vector"] + ["lang_pred", "score"],
            )

    schema = vectors.drop("vector").schema.add("lang_pred", "string").add("score", "double")
    return over_batches(vectors, run, schema)


def held_out(id_column: str, folds: int, fold: int):
    """Whether a row's id, as text, falls into the held-out fold."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold, F.lit(False))


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    folds: int = 4,
    fold: int = 2,
) -> DataFrame:
    """Language of every row: ``doc_id, held_out, lang_pred, score``.

    Prototypes are learnt from rows that have text and a label and are not held out (the
    crc32 of the id leaves another remainder than ``fold``; a null id is never held out).
    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or if
    nothing could be learnt. Texts of any length are read whole; repeated rows stay
    repeated; other columns are ignored.
    """
    named = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        held_out(id_column, folds, fold).alias("held_out"),
        F.col(label).cast("string").alias("label"),
        F.col(text).cast("string").alias("text"),
    )
    vectors = materialize(profiles(named, "text"), "profiles")
    known = prototypes(vectors.where("not held_out"), "label")
    return predictions(vectors.drop("label"), known)


def keep_identified(
    docs: DataFrame, min_score: float = 0.0, id_column: str = "doc_id", text: str = "text",
    label: str = "lang",
) -> DataFrame:
    """The rows whose language can be told; a missing label takes the predicted one.

    Rejected are null texts, texts without letters and, if ``min_score`` asks for it,
    texts unlike every learnt language (two unrelated profiles have a cosine of about
    0 +- 0.04; very short clean texts reach about 0.1). The columns stay as they are,
    whatever their names; rows are judged each for itself.
    """
    training = docs.where(~held_out(id_column, 4, 2)).select(
        F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")
    )
    known = prototypes(profiles(training, "text"), "label")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"))
    judged = predictions(profiles(rows, "_row", text), known)
    kept = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return kept.select(
        *[
            F.coalesce(F.col(f"_row.`{name}`"), "lang_pred").alias(name)
            if name == label
            else F.col(f"_row.`{name}`").alias(name)
            for name in docs.columns
        ]
    )
