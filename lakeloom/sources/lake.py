"""The layered lake: raw JSON, cleaned Parquet, business-ready Parquet, exports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import null_tokens
from lakeloom.sources.files import TIME_FORMAT, read_json, read_parquet


@dataclass(frozen=True)
class WriteResult:
    """What one write did; ``rows`` was counted by the writing job itself."""

    path: str
    rows: int


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _save(df: DataFrame, path: str, kind: str, mode: str, partition_cols: Sequence[str] = (),
          options: dict[str, str] | None = None) -> WriteResult:
    counted, seen = _counted(df)
    writer = counted.write.format(kind).mode(mode).options(**TIME_FORMAT, **(options or {}))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)
    return WriteResult(path, int(seen.get.get("rows", 0)))


@dataclass(frozen=True)
class Lake:
    """Folders of the three layers below one root."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def write_bronze(self, df: DataFrame, table: str, source: str = "import",
                     mode: str = "append", compression: str = "gzip") -> WriteResult:
        """Raw rows as JSON, stamped and partitioned by load date.

        Appends by default; ``mode="overwrite"`` replaces the table. A row of JSON repeats
        every column's name, so the files are compressed; each is read by one task, as it was
        written by one.
        """
        stamped = df.withColumns(
            {
                "_ingested_at": F.current_timestamp(),
                "_source": F.lit(source),
                "_load_date": F.current_date(),
            }
        )
        return _save(stamped, self.path("bronze", table), "json", mode, ["_load_date"],
                     options={"compression": compression})

    def read_bronze(self, table: str, schema: str | T.StructType) -> DataFrame:
        """Raw rows with the contract's types; unreadable lines in a side column."""
        return read_json(self.spark, self.path("bronze", table), schema)

    def write_silver(self, df: DataFrame, table: str, compression: str = "snappy") -> WriteResult:
        """Cleaned rows as Parquet, stamped."""
        stamped = df.withColumns(
            {"_processed_at": F.current_timestamp(), "_quality_check": F.lit("passed")}
        )
        return _save(stamped, self.path("silver", table), "parquet", "overwrite",
                     options={"compression": compression})

    def read_silver(self, table: str) -> DataFrame:
        return read_parquet(self.spark, self.path("silver", table))

    def write_gold(self, df: DataFrame, name: str, partition_cols: Sequence[str] = (),
                   mode: str = "overwrite", sort_by: Sequence[str] = (),
                   compression: str = "snappy") -> WriteResult:
        """A business table as Parquet, stamped.

        ``mode="partitions"`` replaces only the partitions present in ``df``.
        Before a partitioned write, rows are gathered by partition value; a
        very large partition is split over several tasks and files.
        """
        stamped = df.withColumn("_aggregated_at", F.current_timestamp())
        if partition_cols:
            stamped = stamped.hint("rebalance", *partition_cols)
        if sort_by:
            stamped = stamped.sortWithinPartitions(*partition_cols, *sort_by)
        options = {"compression": compression}
        if mode == "partitions":
            mode, options["partitionOverwriteMode"] = "overwrite", "dynamic"
        return _save(stamped, self.path("gold", name), "parquet", mode, partition_cols, options)

    def read_gold(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.path("gold", name))


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              sort_by: Sequence[Column | str] = ()) -> WriteResult:
    """CSV with a header. ``single_file`` is for small, aggregated results only.

    The rows of a single file meet in one task after a shuffle, so what computes them stays
    parallel; ``sort_by`` orders them there (an order from before would be lost).
    """
    rows = df.repartition(1) if single_file else df
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    return _save(rows, path, "csv", "overwrite", options={"header": "true"})


def export_text(df: DataFrame, path: str, null_string: str = "null",
                null_non_string: str = "null") -> WriteResult:
    """Delimited text in which NULL is a token, one for strings, one for the rest.

    Binary columns are left out.
    """
    return _save(null_tokens(df, null_string, null_non_string), path, "csv", "overwrite",
                 options={"header": "true", "emptyValue": ""})


def without_stamps(df: DataFrame) -> DataFrame:
    """Drop the stamps a layer added (columns that start with an underscore)."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])
