"""Profiles of loads that add up: what a table holds, without reading old loads again.

Beside each load one row per column is stored, with sketches of fixed size: distinct values,
quantiles (numbers and times) and frequent values. Profiles of any loads are merged from
these rows alone, and two of them are compared to see whether a column has drifted. Taking
a profile is one pass over the load; only sketches are shuffled, one for each task.

Counts, smallest and largest values are exact. Distinct counts are within about 2 %
(``DISTINCT_BITS``), ranks of quantiles within about half a percent (``QUANTILE_SIZE``), and
counts of frequent values exact while a column has at most three quarters of ``TRACKED``
values and never off by more than the rows divided by about that number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "load"
DISTINCT_BITS = 13
QUANTILE_SIZE = 800
TRACKED = 8192
MEASURED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(column: Column, kind: T.DataType) -> Column:
    """Numbers as they are, dates and times as seconds in UTC, others NULL; NaN counts as NULL."""
    if isinstance(kind, T.TimestampNTZType):
        column = F.convert_timezone(F.lit("UTC"), F.current_timezone(), column).cast("timestamp")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return (F.unix_micros(column.cast("timestamp")) / 1_000_000).cast("double")
    if isinstance(kind, T.NumericType):
        value = column.cast("double")
        return F.when(~F.isnan(value), value)
    return F.lit(None).cast("double")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: counts, ends and sketches. Columns are of plain types."""
    numbers = {c: isinstance(df.schema[c].dataType, MEASURED) for c in columns}
    placed = df.select(
        *[F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(columns)],
        *[_number(F.col(c), df.schema[c].dataType).alias(f"x{i}") for i, c in enumerate(columns)],
    )
    found = []
    for i, name in enumerate(columns):
        ends = f"cast(null as string) as low_{i}, cast(null as string) as high_{i}"
        if not numbers[name]:
            ends = f"min(t{i}) as low_{i}, max(t{i}) as high_{i}"
        found += [
            f"count(*) - count(t{i}) as nulls_{i}",
            f"hll_sketch_agg(t{i}, {DISTINCT_BITS}) as distinct_{i}",
            f"kll_sketch_agg_double(x{i}, {QUANTILE_SIZE}) as quantiles_{i}",
            f"approx_top_k_accumulate(t{i}, {TRACKED}) filter (where t{i} is not null) as frequent_{i}",
            *ends.split(", "),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(numbers[name]).alias("measured"),
            F.col("_n").alias("n_rows"),
            *[F.col(f"{part}_{i}").alias(part) for part in ("nulls", "low", "high", "distinct", "quantiles", "frequent")],
        )
        for i, name in enumerate(columns)
    ]
    return placed.selectExpr("count(*) as _n", *found).select(F.inline(F.array(*lines)))


def store_profile(df: DataFrame, path: str, load: int, columns: Sequence[str]) -> None:
    """Store the profile of a load beside those of others; a repeated load replaces its own."""
    profile(df, columns).write.mode("overwrite").parquet(f"{path}/{LOAD}={int(load)}")


def merged(spark: SparkSession, path: str, loads: Sequence[int] | None = None) -> DataFrame:
    """The profile of several loads (default: all) from their stored profiles."""
    rows = spark.read.parquet(path)
    if loads is not None:
        rows = rows.filter(F.col(LOAD).isin(list(loads)))
    return rows.groupBy("column").agg(
        F.first("measured").alias("measured"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def _quantiles(sketch: str, shares: Sequence[float]) -> Column:
    """Values at the shares; NULL for a sketch without values."""
    ranks = ", ".join(f"cast({s} as double)" for s in shares)
    return F.expr(
        f"case when kll_sketch_get_n_double({sketch}) > 0 then kll_sketch_get_quantile_double({sketch}, array({ranks})) end"
    )


def describe(profiles: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Figures of a profile: ends as text, about how many values, values at the shares.

    Numbers and times have their ends as numbers (times in seconds).
    """
    ends = _quantiles("quantiles", [0.0, 1.0])
    return profiles.select(
        "column",
        "n_rows",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(F.col("measured"), ends[0].cast("string")).otherwise(F.col("low")).alias("lowest"),
        F.when(F.col("measured"), ends[1].cast("string")).otherwise(F.col("high")).alias("highest"),
        F.when(F.col("measured"), _quantiles("quantiles", shares)).alias("quantiles"),
    )


def frequent_values(profiles: DataFrame, k: int) -> DataFrame:
    """``column, value, n``: about the ``k`` most frequent values of each column.

    The value is text, and NULLs do not count.
    """
    items = F.explode(F.expr(f"approx_top_k_estimate(frequent, {k})")).alias("_v")
    return profiles.filter("nulls < n_rows").select("column", items).select(
        "column", F.col("_v.item").alias("value"), F.col("_v.count").alias("n")
    )


def drift(before: DataFrame, after: DataFrame, limit: float = 0.1, steps: int = 200) -> DataFrame:
    """``column, null_change, distance, drifted`` of two profiles.

    The distance of numbers and times is the largest difference of their shares up to any
    point (read off ``steps`` quantiles of both sides, so within 1 / ``steps`` and their errors), that of others half the sum of
    the differences of the shares of the tracked values. A column has drifted if the
    distance or the change of the share of NULLs is above ``limit``. A column without values
    on one side only has distance 1. Columns that are on one side only are left out.
    """
    left = before.select(*[F.col(c).alias(f"a_{c}") for c in before.columns])
    right = after.select(*[F.col(c).alias(f"b_{c}") for c in after.columns])
    both = left.join(right, F.col("a_column") == F.col("b_column"))
    shares = [i / steps for i in range(steps + 1)]
    kept = {s: (F.col(f"{s}_n_rows") - F.col(f"{s}_nulls")).cast("double") for s in "ab"}
    quantiles = both.withColumns({f"_{s}": _quantiles(f"{s}_quantiles", shares) for s in "ab"})
    ranked = quantiles.withColumn("_points", F.array_distinct(F.concat("_a", "_b")))

    def gap(point: Column) -> Column:
        upto = [F.size(F.filter(side, lambda v: v <= point)) for side in ("_a", "_b")]
        return F.abs(upto[0] - upto[1]) / (steps + 1)

    measured = ranked.filter("a_measured and b_measured").select(
        F.col("a_column").alias("column"), F.array_max(F.transform("_points", gap)).alias("_gap")
    )
    sides = [
        frequent_values(side, TRACKED * 3 // 4).select("column", "value", *[(F.col("n") * sign).alias(name) for name, sign in counts])
        for side, counts in ((before, (("a", 1), ("b", 0))), (after, (("a", 0), ("b", 1))))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("column", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = both.select(F.col("a_column").alias("column"), kept["a"].alias("_a"), kept["b"].alias("_b"))
    named = (
        counts.join(rows, "column")
        .groupBy("column")
        .agg((F.sum(F.abs(F.try_divide("a", "_a") - F.try_divide("b", "_b"))) / 2).alias("_half"))
    )
    change = F.abs(F.try_divide("b_nulls", "b_n_rows") - F.try_divide("a_nulls", "a_n_rows"))
    one_sided = (kept["a"] > 0) != (kept["b"] > 0)
    distance = F.when(one_sided, 1.0).otherwise(
        F.coalesce(F.when(F.col("a_measured") & F.col("b_measured"), F.col("_gap")).otherwise(F.col("_half")), F.lit(0.0))
    )
    joined = both.withColumnRenamed("a_column", "column").join(measured, "column", "left").join(named, "column", "left")
    found = joined.select("column", F.coalesce(change, F.lit(0.0)).alias("null_change"), distance.alias("distance"))
    return found.withColumn("drifted", (F.col("distance") > limit) | (F.col("null_change") > limit))
