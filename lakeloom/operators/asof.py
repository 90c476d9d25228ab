"""Totals as of many dates in one sweep.

Entries and questions are put in one order by key and time. The order is cut into ranges of
about equal size, so that a key with very many entries is spread over several tasks; each
range is swept with running sums, and what a key has brought to the end of earlier ranges
is carried into the next ones. Entries of one key and time are summed before, and equal
questions asked once, so that neither makes a range large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import materialize


def totals_as_of(entries: DataFrame, asked: DataFrame, key: str, at: str, measures: Sequence[str]) -> DataFrame:
    """``key``, ``at`` of every different question and the sums of all entries up to then.

    Entries at the very time count. A question without entries, or with a NULL key or time,
    gets zeros. Sums keep the measures' kind (decimals and whole numbers are exact).
    """
    kinds = dict(entries.dtypes)
    wide = {m: f"decimal(38,{kinds[m].split(',')[1][:-1]})" if kinds[m].startswith("decimal") else "bigint" for m in measures}
    zero = {m: F.lit(0).cast(wide[m]) for m in measures}
    lines = (
        entries.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(key, at)
        .agg(*[F.coalesce(F.sum(m).cast(wide[m]), zero[m]).alias(m) for m in measures])
        .select(key, at, F.lit(0).alias("_asked"), *measures)
    )
    questions = asked.select(key, at).distinct().select(
        key, at, F.lit(1).alias("_asked"), *[zero[m].alias(m) for m in measures]
    )
    ranged = materialize(
        lines.unionByName(questions)
        .repartitionByRange(key, at)
        .withColumn("_part", F.spark_partition_id()),
        "sweep",
    )
    # A line for each key of a range; a key has as many as the ranges it reaches over.
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("_part", key)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .withColumns({f"_before_{m}": F.sum(m).over(before) for m in measures})
        .select(F.col("_part").alias("_in"), F.col(key).alias("_key"), *[f"_before_{m}" for m in measures])
        .filter(F.col(f"_before_{measures[0]}").isNotNull())
    )
    sweep = Window.partitionBy("_part", key).orderBy(at, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumns({m: F.sum(m).over(sweep) for m in measures}).filter("_asked = 1")
    same = (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key"))
    nothing = F.col(key).isNull() | F.col(at).isNull()
    return swept.join(carried, same, "left").select(
        key,
        at,
        *[
            F.when(nothing, zero[m])
            .otherwise((F.col(m) + F.coalesce(F.col(f"_before_{m}"), zero[m])).cast(wide[m]))
            .alias(m)
            for m in measures
        ],
    )
