"""Change records: one JSON row image per record, topic ``system.schema.table``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.schemas import CHANGE_RECORD

BAD = "_bad_value"


def read_change_topics(spark: SparkSession, servers: str, pattern: str,
                       options: Mapping[str, str] | None = None) -> DataFrame:
    """Change records from message topics (needs the Kafka connector package)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .options(**(options or {}))
        .load()
    )
    return raw.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
    )


def read_change_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Change records of the same shape from JSON files, as a stream."""
    return (
        spark.readStream.schema(CHANGE_RECORD)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def parse_changes(records: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Typed rows from change records, next to their topic, key and time.

    A value that is not valid JSON for the schema keeps its text in a side
    column and has NULL in all data columns.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*declared.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = records.withColumn("_row", F.from_json("value", wide, options))
    return parsed.select("topic", "key", "ts", "_row.*")


def table_of(topic: Column) -> Column:
    """Last part of a topic name; tables of several schemas may share it."""
    return F.element_at(F.split(topic, r"\."), -1)
