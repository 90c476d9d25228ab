"""Relational building blocks beyond a single join or aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.money import rounded_ratio
from lakeloom.functions.text import tokens
from lakeloom.session import materialize, materialize_counted

REACHED, ORPHAN, CYCLE = "reached", "orphan", "cycle"


def ordered_list(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    separator: str = ", ",
    distinct: bool = False,
    name: str | None = None,
) -> DataFrame:
    """Values of a group as one ordered, separated string; NULLs are skipped.

    One shuffle by the keys. The text of a group must fit in one row, as the result
    asks for it; ``distinct`` values are made so in each task before the shuffle.
    """
    values = F.collect_set(value) if distinct else F.collect_list(value)
    text = F.array_join(F.array_sort(values), separator)
    present = df.filter(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(text.alias(name or value))


def hierarchy(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Depth of every row below its root, for a self reference ``parent -> key``.

    Returns every row as ``key, parent, depth, state``. Rows below a parent that does not
    exist are ``orphan``, rows in or below a reference cycle ``cycle``; both have a NULL
    depth. Each round doubles the distance a row looks up, so the number of rounds is the
    logarithm of the depth, whatever the depth; rows without an end after that many rounds
    as the row count allows are in a cycle. Each round is written once (jobs run while the
    plan is built). A repeated key counts once as a parent.
    """
    start = F.when(F.col(parent).isNull(), F.lit(0).cast("bigint"))
    rows, n = materialize_counted(
        df.select(
            key,
            parent,
            F.col(parent).alias("_above"),
            F.lit(1).cast("bigint").alias("_steps"),
            start.alias("depth"),
            F.when(start.isNotNull(), REACHED).alias("state"),
        ),
        "hierarchy",
    )
    for _ in range(n.bit_length() + 1):
        if rows.filter("state is null").isEmpty():
            break
        ends = F.struct("depth", "state", "_above", "_steps")
        above = rows.groupBy(F.col(key).alias("_key")).agg(F.min(ends).alias("_up"))
        up = F.col("_up")
        looked = (
            rows.filter("state is null")
            .join(above, F.col("_above") == F.col("_key"), "left")
            .select(
                key,
                parent,
                up["_above"].alias("_above"),
                (F.col("_steps") + up["_steps"]).alias("_steps"),
                (F.col("_steps") + up["depth"]).alias("depth"),
                F.when(up.isNull(), ORPHAN).otherwise(up["state"]).alias("state"),
            )
        )
        rows = materialize(rows.filter("state is not null").unionByName(looked), "hierarchy")
    return rows.select(
        key, parent, "depth", F.coalesce("state", F.lit(CYCLE)).alias("state")
    )


def with_parent(df: DataFrame, key: str, parent: str, label: str, name: str) -> DataFrame:
    """Add the label of the parent row (self join); roots get NULL."""
    above = df.select(F.col(key).alias("_parent_key"), F.col(label).alias(name))
    return df.join(above, F.col(parent) == F.col("_parent_key"), "left").drop("_parent_key")


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that occur in ``keys`` (EXISTS).

    Distinct keys first: a key repeated very often is dropped before the shuffle.
    """
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that do not occur in ``keys`` (NOT EXISTS)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def bucket(column: str, width: int):
    """Lower bound of the fixed-width bucket a number falls in."""
    return (F.floor(F.col(column) / F.lit(width)) * F.lit(width)).cast("bigint")


def rate_by_value(
    df: DataFrame, by: Sequence[str], outcome: str, digits: int = 4
) -> DataFrame:
    """Rows, positive outcomes and outcome rate per value of ``by``."""
    grouped = df.groupBy(*by).agg(
        F.count(outcome).alias("n"), F.sum(F.col(outcome).cast("bigint")).alias("positives")
    )
    return grouped.withColumn("rate", rounded_ratio(F.col("positives"), F.col("n"), digits))


def condition_effects(
    df: DataFrame, conditions: Sequence[str], outcome: str, digits: int = 4
) -> DataFrame:
    """Outcome rate with and without each 0/1 condition, and their ratio.

    One row per condition; all conditions are counted in one pass.
    """
    hit = F.col(outcome) == 1
    counts = []
    for i, condition in enumerate(conditions):
        has = F.col(condition) == 1
        counts += [
            F.count_if(has).alias(f"w{i}"),
            F.count_if(has & hit).alias(f"wp{i}"),
            F.count_if(~has).alias(f"o{i}"),
            F.count_if(~has & hit).alias(f"op{i}"),
        ]
    rows = [
        F.struct(
            F.lit(condition).alias("condition"),
            F.col(f"w{i}").alias("n_with"),
            F.col(f"wp{i}").alias("positives_with"),
            F.col(f"o{i}").alias("n_without"),
            F.col(f"op{i}").alias("positives_without"),
        )
        for i, condition in enumerate(conditions)
    ]
    totals = df.agg(*counts).select(F.inline(F.array(*rows)))
    crossed = F.col("positives_with") * F.col("n_without")
    against = F.col("positives_without") * F.col("n_with")
    return totals.select(
        "*",
        rounded_ratio(F.col("positives_with"), F.col("n_with"), digits).alias("rate_with"),
        rounded_ratio(F.col("positives_without"), F.col("n_without"), digits).alias("rate_without"),
        rounded_ratio(crossed, against, digits).alias("risk_ratio"),
    )


def search_tokens(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Token table ``(key, token)`` over the whole text of several columns."""
    text = F.concat_ws(" ", *[F.col(c) for c in columns])
    return df.select(key, F.explode(tokens(text)).alias("token"))


def search(df: DataFrame, key: str, columns: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """Rows whose text contains every search term; judged row by row, no shuffle."""
    wanted = sorted({t.lower() for t in terms})
    words = tokens(F.concat_ws(" ", *[F.col(c) for c in columns]))
    return df.filter(F.size(F.array_intersect(words, F.array(*map(F.lit, wanted)))) == len(wanted))
