"""File and in-memory sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Text formats write whole milliseconds unless told otherwise; readers accept this form.
TIME_FORMAT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def snake_case(name: str) -> str:
    """``"First Name"`` -> ``"first_name"``."""
    return re.sub(r"\W+", "_", name.strip()).strip("_").lower()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    date_format: str = "yyyy-MM-dd",
    snake_names: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, quoted fields and doubled quotes.

    Without a schema all columns are read with inferred types, which costs one
    more pass over the files. ``multi_line`` is needed only for line breaks
    inside quotes, as such files cannot be split.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("dateFormat", date_format)
        .option("multiLine", multi_line)
    )
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.schema(schema).csv(path)
    return df.toDF(*[snake_case(c) for c in df.columns]) if snake_names else df


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines with an enforced schema; unreadable lines go to a side column."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None):
    """Parquet folder, with partition columns from the folder names."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: Sequence[str] | str) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def gen_range(spark: SparkSession, n: int, partitions: int, seed: int = 42) -> DataFrame:
    """``n`` numbered rows with a reproducible random value."""
    # The generator's state depends on the partition, so the split is fixed.
    return spark.range(0, n, 1, partitions).withColumn("random_value", F.rand(seed))
