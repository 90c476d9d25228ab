"""The corpus pipeline: raw documents to identified, deduplicated, clean, encoded ones.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import decontam, langid, pieces, pseudonyms, simhash
from lakeloom.llm.queries import PSEUDONYM_KEY, piece_model
from lakeloom.llm.shared import session, table
from lakeloom.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no text, no letter) go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms; every document stays."""
    return pseudonyms.with_length(pseudonyms.pseudonymise(docs, PSEUDONYM_KEY))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; decoding them gives its text back."""
    return pieces.encode(docs, piece_model(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonymisation", pseudonymisation),
    ("encoding", encoding),
]

# No SQL form: fingerprints, models and piece tables are beyond SQL; tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage written and read again."""
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
