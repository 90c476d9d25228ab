"""Latest rows, top rows and global ranks without a single-task sort.

A window without a partition key sends every row to one task. A rank or a running total
depends on distinct values only, so those are counted first: a value shared by very many
rows becomes one row. The distinct values are sorted by range over as many partitions as
the session shuffles to and written once with their partition's number; totals per
partition, one row each, give every partition its offset, and the finished numbers are
joined back to the rows by value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.money import percent, rank_percent, rounded_ratio
from lakeloom.session import materialize


def latest_by_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``newest`` columns per key.

    The remaining columns break ties, so the result is deterministic. It is an
    aggregate, not a window: each task first sorts its rows and keeps one per key,
    so a key with very many versions never gathers in one task.
    """
    others = [c for c in df.columns if c not in keys]
    order = [*newest, *(c for c in others if c not in newest)]
    order = [c for c in order if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def most_frequent(df: DataFrame, by: Sequence[str], value: str, count_name: str = "n") -> DataFrame:
    """Most frequent value per group; ties go to the smaller value."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias(count_name))
    first = F.min(F.struct((-F.col(count_name)).alias("_minus"), F.col(value))).alias("_first")
    return counts.groupBy(*by).agg(first).select(
        *by,
        F.col(f"_first.{value}").alias(value),
        (-F.col("_first._minus")).alias(count_name),
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order (each task keeps only its own first n)."""
    return df.orderBy(*order).limit(n)


@dataclass(frozen=True)
class Totals:
    """Distinct values with what lies before each; ``totals`` over all rows."""

    table: DataFrame
    totals: dict[str, object]


def running_totals(
    rows: DataFrame, column: str, measures: Mapping[str, Column], descending: bool = True
) -> Totals:
    """Per distinct value, its measures and their totals over all rows before it.

    ``measures`` are aggregates whose values add up. The table has ``column`` (NULL last),
    the measures and ``<measure>_before``. ``rows`` is read once.
    """
    names = list(measures)
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    values = (
        rows.groupBy(column)
        .agg(*[c.alias(n) for n, c in measures.items()])
        .repartitionByRange(order)
        .withColumn("_range", F.spark_partition_id())
    )
    stored = materialize(values, "values")
    kinds = dict(stored.dtypes)
    wide = {n: "decimal(38,2)" if kinds[n].startswith("decimal") else "bigint" for n in names}
    sums = [F.coalesce(F.sum(n).cast(wide[n]), F.lit(0).cast(wide[n])).alias(n) for n in names]
    # One row for each partition of the values: as many as the session shuffles to.
    found = sorted(stored.groupBy("_range").agg(*sums).collect(), key=lambda r: r["_range"])
    running = {n: Decimal(0) if t.startswith("decimal") else 0 for n, t in wide.items()}
    lines = []
    with localcontext(prec=40):
        for row in found:
            lines.append((row["_range"], *running.values()))
            running = {n: running[n] + row[n] for n in names}
    schema = ["_range int", *[f"`_offset_{n}` {t}" for n, t in wide.items()]]
    offsets = rows.sparkSession.createDataFrame(lines, ", ".join(schema))
    above = (
        Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    table = stored.join(offsets, "_range").select(
        column,
        *names,
        *[
            (F.coalesce(F.sum(n).over(above), F.lit(0)) + F.col(f"_offset_{n}"))
            .cast(wide[n])
            .alias(f"{n}_before")
            for n in names
        ],
    )
    return Totals(table, running)


def _by_value(rows: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    """Join per-value numbers to the rows; adaptive execution splits a value with many rows."""
    named = numbers.withColumnRenamed(column, "_value")
    return rows.join(named, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def global_rank(
    df: DataFrame,
    by: str,
    dense: str | None = "dense_rank",
    percentile: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Dense rank and percent rank (times 100, two decimals) over the whole table.

    Equal to windows ordered by ``by`` alone, NULLs last. ``df`` is written once, as it is
    read twice; jobs run while the plan is built.
    """
    rows = materialize(df, "ranked")
    run = running_totals(
        rows, by, {"_rows": F.count("*"), "_values": F.lit(1).cast("bigint")}, descending
    )
    others = F.lit(max(run.totals["_rows"] - 1, 1)).cast("bigint")
    found = []
    if dense:
        found.append((F.col("_values_before") + 1).cast("int").alias(dense))
    if percentile:
        found.append(rank_percent(F.col("_rows_before"), others).alias(percentile))
    return _by_value(rows, by, run.table.select(by, *found))


def cumulative_share(df: DataFrame, value: str, descending: bool = True) -> DataFrame:
    """Running total of ``value`` and its share of the grand total.

    Rows with equal values are peers and get the same running total, as in a
    window with the default frame.
    """
    rows = materialize(df, "share")
    run = running_totals(rows, value, {"_sum": F.sum(value)}, descending)
    running = F.col("_sum_before") + F.coalesce("_sum", F.lit(0))
    shares = run.table.select(value, running.alias("running_total")).withColumn(
        "share_pct", percent(F.col("running_total"), F.lit(run.totals["_sum"]))
    )
    return _by_value(rows, value, shares)


def pareto(df: DataFrame, value: str, head_pct: int = 1, target_pct: int = 80) -> DataFrame:
    """Two facts about the largest rows, as one row.

    The share held by the top ``head_pct`` percent of the rows (rounded up),
    and the smallest number of rows that holds ``target_pct`` percent of the
    total. Rows that tie are interchangeable, so distinct values with their
    counts are enough.
    """
    rows = df.select(value).filter(F.col(value).isNotNull())
    run = running_totals(rows, value, {"_n": F.count("*"), "_sum": F.sum(value)})
    n, total = run.totals["_n"], run.totals["_sum"]
    head = -(-n * head_pct // 100)
    with localcontext(prec=40):
        goal = total * target_pct  # in hundredths of the total
    taken = F.least(F.greatest(F.lit(head) - F.col("_n_before"), F.lit(0)), F.col("_n"))
    missing = F.lit(goal) - F.col("_sum_before") * 100
    crossing = (missing > 0) & (F.col("_sum") * 100 >= missing)
    needed = F.col("_n_before") + F.ceil(F.try_divide(missing, F.col(value) * 100))
    facts = run.table.agg(
        F.sum(taken * F.col(value)).alias("head_total"),
        F.min(F.when(crossing, needed)).cast("bigint").alias("rows_for_target"),
    )
    return facts.select(
        F.lit(n).cast("bigint").alias("n_rows"),
        F.lit(head).cast("bigint").alias("head_rows"),
        F.col("head_total").cast("decimal(30,2)").alias("head_total"),
        percent(F.col("head_total"), F.lit(total)).alias("head_share_pct"),
        "rows_for_target",
        rounded_ratio(F.col("rows_for_target") * 100, F.lit(n)).alias("rows_for_target_pct"),
    )
