"""Small documents with the awkward cases that every operator must stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, "
    "label string, _row string, component_id bigint, ids string, `a.b` string, "
    "_kept_id bigint, _found_values string, _text string, vector string, item_ids string"
)
LONG = "lorem ipsum dolor sit amet, consectetur adipiscing elit " * 4000


def awkward(spark: SparkSession) -> DataFrame:
    """Null, empty, blank, very long and repeated texts, null ids, clashing columns."""
    texts = [
        (1, "The quick brown fox jumps over the lazy dog."),
        (2, None),
        (3, ""),
        (4, " \t\n"),
        (5, LONG),
        (6, "The quick brown fox jumps over the lazy dog."),
        (6, "The quick brown fox jumps over the lazy dog."),
        (None, "The quick brown fox jumps over the lazy dog."),
        (None, None),
        (7, "12345 --- 67890"),
        (8, "Ünïcödé 漢字 😀 \u0000 ▁ end"),
    ]
    rows = [
        (i, t, "xx" if k % 3 else None, None, None, k, "x", "y", -1, "z", "w", 9, "v", "t", "q", "r")
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def plain(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
