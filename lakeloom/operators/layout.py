"""Comparison of storage layouts for a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.money import rounded_ratio


def layout_report(df: DataFrame, layouts: Mapping[str, Column], probes: Mapping[str, Column]) -> DataFrame:
    """One row per candidate partition column.

    Partitions, rows, the fullest partition, its ratio to the mean partition,
    and for each probe (a query's filter) the number of partitions it touches.
    The table is read once: all layouts are counted from one aggregate.
    """
    named = df.select(
        *[c.cast("string").alias(n) for n, c in layouts.items()],
        *[c.cast("int").alias(f"_probe_{p}") for p, c in probes.items()],
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("layout"), F.col(n).alias("part")) for n in layouts])
    marks = [F.max(f"_probe_{p}").alias(f"_probe_{p}") for p in probes]
    counts = (
        named.select(F.inline(pairs), *[f"_probe_{p}" for p in probes])
        .groupBy("layout", "part")
        .agg(F.count("*").alias("n"), *marks)
    )
    report = counts.groupBy("layout").agg(
        F.count("*").alias("partitions"),
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_rows"),
        *[F.count_if(F.col(f"_probe_{p}") == 1).alias(f"touched_by_{p}") for p in probes],
    )
    skew = rounded_ratio(F.col("max_rows") * F.col("partitions"), F.col("n_rows"))
    return report.withColumn("skew_ratio", skew)
