"""Interval labels of a hierarchy: everything below a row is a range.

A walk around each tree enters every row once and leaves it once. Which step follows which
is known from parents and neighbours alone; how far each step is from the end of its walk
is found by doubling: every round looks up the step that the known one points to and adds
its distance, so the rounds are the logarithm of the longest walk, whatever the depth. A
row's labels are its two distances: rows below it have theirs between them. Each step has
one step before it, so no key of these joins is hot; the children of a row with very many
are spread over ranges of the sorted order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import materialize, materialize_counted


def _siblings(rows: DataFrame) -> DataFrame:
    """``key``, ``parent``, the next child of the same parent and whether it is the first one.

    Rows are sorted by range; the last row of a range is joined to the first row after it.
    The driver holds one row for each range.
    """
    ranged = materialize(
        rows.repartitionByRange("parent", "key").withColumn("_range", F.spark_partition_id()), "siblings"
    )
    ends = F.struct("parent", "key")
    firsts = sorted(
        ranged.groupBy("_range").agg(F.min(ends).alias("a"), F.max(ends).alias("z")).collect(),
        key=lambda r: r["_range"],
    )
    kind = ranged.schema["key"].dataType.simpleString()
    edge = f"_range int, _after struct<parent:{kind},key:{kind}>, _prior struct<parent:{kind},key:{kind}>"
    lines = [
        (
            row["_range"],
            tuple(firsts[i + 1]["a"]) if i + 1 < len(firsts) else None,
            tuple(firsts[i - 1]["z"]) if i else None,
        )
        for i, row in enumerate(firsts)
    ]
    borders = rows.sparkSession.createDataFrame(lines, edge)
    order = Window.partitionBy("_range").orderBy("parent", "key")
    after = F.coalesce(F.lead(ends).over(order), F.col("_after"))
    prior = F.coalesce(F.lag(ends).over(order), F.col("_prior"))
    same = lambda other: other["parent"].eqNullSafe(F.col("parent"))
    return ranged.join(borders, "_range").select(
        "key",
        "parent",
        F.when(F.col("parent").isNotNull() & same(after), after["key"]).alias("next"),
        (F.col("parent").isNotNull() & ~F.coalesce(same(prior), F.lit(False))).alias("is_first"),
    )


def _steps(rows: DataFrame) -> DataFrame:
    """The steps of all walks: each with the step after it (NULL at the end) and its change of depth."""
    placed = materialize(_siblings(rows), "placed")
    first = placed.filter("is_first").select(F.col("parent").alias("key"), F.col("key").alias("child"))
    enter = placed.join(first, "key", "left").select(
        "key",
        F.lit(False).alias("leaves"),
        F.coalesce("child", "key").alias("to_key"),
        F.col("child").isNull().alias("to_leaves"),
        F.lit(-1).cast("bigint").alias("level"),
    )
    leave = placed.select(
        "key",
        F.lit(True).alias("leaves"),
        F.coalesce("next", "parent").alias("to_key"),
        F.col("next").isNull().alias("to_leaves"),
        F.lit(1).cast("bigint").alias("level"),
    )
    return enter.unionByName(leave)


def interval_labels(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``key, parent, root, depth, low, high, n_below`` for every key of a self reference.

    A row is below another one if both have the same ``root`` and its ``high`` lies between
    the other's ``low`` and ``high``. Rows without a parent and rows whose parent does not
    exist are roots (depth 0). Rows in or below a cycle have NULL labels. Rows without a key
    are left out; of a repeated key the smallest parent that is not NULL counts. Key and
    parent must be of one kind. Every round is written once (jobs run while the plan is built).
    """
    kind = df.schema[key].dataType
    named = df.select(F.col(key).alias("key"), F.col(parent).cast(kind).alias("_up")).filter("key is not null")
    keys, n = materialize_counted(named.groupBy("key").agg(F.min("_up").alias("_up")), "keys")
    known = keys.select(F.col("key").alias("parent"))
    rows = keys.join(known, F.col("_up") == F.col("parent"), "left").select("key", "parent")
    one = F.lit(1).cast("bigint")
    done = F.col("to_key").isNull()
    steps = materialize(
        _steps(rows).select(
            "key", "leaves", "to_key", "to_leaves", one.alias("far"), "level", F.when(done, F.col("key")).alias("root")
        ),
        "steps",
    )
    for _ in range((2 * n).bit_length() + 1):
        if steps.filter("root is null").isEmpty():
            break
        ahead = steps.select(
            F.col("key").alias("_key"),
            F.col("leaves").alias("_leaves"),
            *[F.col(c).alias(f"_{c}_2") for c in ("to_key", "to_leaves", "far", "level", "root")],
        )
        at = (F.col("to_key") == F.col("_key")) & (F.col("to_leaves") == F.col("_leaves"))
        moved = steps.filter("root is null").join(ahead, at).select(
            "key",
            "leaves",
            F.col("_to_key_2").alias("to_key"),
            F.col("_to_leaves_2").alias("to_leaves"),
            (F.col("far") + F.col("_far_2")).alias("far"),
            (F.col("level") + F.col("_level_2")).alias("level"),
            F.col("_root_2").alias("root"),
        )
        steps = materialize(steps.filter("root is not null").unionByName(moved), "steps")

    def found(leaves: bool, name: str) -> Column:
        here = F.col("root").isNotNull() & (F.col("leaves") == leaves)
        return F.max(F.when(here, F.col(name)))

    labels = steps.groupBy("key").agg(
        F.max("root").alias("root"),
        found(False, "level").alias("depth"),
        found(True, "far").alias("low"),
        found(False, "far").alias("high"),
    )
    below = F.expr("(high - low - 1) div 2").alias("n_below")
    return keys.join(labels, "key").select(
        F.col("key").alias(key), F.col("_up").alias(parent), "root", "depth", "low", "high", below
    )


def rows_below(labels: DataFrame, key: str, above: DataFrame) -> DataFrame:
    """Pairs ``above, below``: every row below each key of ``above`` (one column ``key``).

    An interval is a few blocks of lengths that are powers of two, a point lies in one block
    of each length, so the range join is an equality join on blocks: no pair is met that is
    not in the result, and each is met once. Only lengths that occur are looked up.
    """
    asked = above.select(key).distinct().join(labels, key).filter("root is not null and n_below > 0")
    blocks = asked.select(
        F.col(key).alias("above"), F.col("root").alias("_root"), F.explode(_blocks()).alias("_b")
    ).select("above", "_root", F.col("_b.width").alias("_width"), F.col("_b.block").alias("_block"))
    blocks = materialize(blocks, "blocks")
    widths = [r[0] for r in blocks.select("_width").distinct().collect()]  # at most 63
    if not widths:
        return blocks.select("above", F.col("_root").alias("below")).limit(0)
    cells = F.explode(F.array(*[F.struct(F.lit(w).alias("width"), F.shiftright("high", w).alias("block")) for w in sorted(widths)]))
    points = labels.filter("root is not null").select(F.col(key).alias("below"), "root", cells.alias("_c"))
    same = (F.col("root") == F.col("_root")) & (F.col("_c.width") == F.col("_width")) & (F.col("_c.block") == F.col("_block"))
    return points.join(blocks, same).select("above", "below")


def _blocks() -> Column:
    """Blocks (width, block) that make up the points between ``low`` and ``high``, both left out.

    From both ends inwards: at each width a block that sticks out on the left or right is taken.
    """
    start = F.struct(
        (F.col("low") + 1).alias("a"),
        F.col("high").alias("z"),
        F.expr("cast(array() as array<struct<width:int,block:bigint>>)").alias("found"),
    )

    def widen(state: Column, width: Column) -> Column:
        a, z = state["a"], state["z"]
        none = F.expr("cast(array() as array<struct<width:int,block:bigint>>)")
        open_ = a < z
        left = F.when(open_ & (a % 2 == 1), F.array(F.struct(width.alias("width"), a.alias("block")))).otherwise(none)
        right = F.when(open_ & (z % 2 == 1), F.array(F.struct(width.alias("width"), (z - 1).alias("block")))).otherwise(none)
        return F.struct(
            F.when(open_, F.shiftright(a + 1, 1)).otherwise(F.lit(0).cast("bigint")).alias("a"),
            F.when(open_, F.shiftright(z, 1)).otherwise(F.lit(0).cast("bigint")).alias("z"),
            F.concat(state["found"], left, right).alias("found"),
        )

    widths = F.sequence(F.lit(0), F.lit(62))
    return F.aggregate(widths, start, widen, lambda state: state["found"])


def totals_below(labels: DataFrame, key: str, rows: DataFrame, measures: list[str]) -> DataFrame:
    """``key`` and the sums of ``measures`` over the key itself and all rows below it.

    ``rows`` are summed per key first. Labels are put in order once, over ranges with carried
    totals; a row's sum is the difference of the running totals at its two labels, so the
    cost does not grow with the depth. Keys in or below cycles are left out. Sums are whole
    numbers or decimals.
    """
    kinds = dict(rows.dtypes)
    wide = {m: f"decimal(38,{kinds[m].split(',')[1][:-1]})" if kinds[m].startswith("decimal") else "bigint" for m in measures}
    zero = {m: F.lit(0).cast(wide[m]) for m in measures}
    sums = rows.groupBy(key).agg(*[F.sum(m).cast(wide[m]).alias(m) for m in measures])
    placed = labels.filter("root is not null").select(key, "root", "low", "high").join(sums, key, "left")
    ends = placed.select(
        key,
        "root",
        F.inline(
            F.array(
                F.struct(F.col("low").alias("at"), F.lit(-1).alias("_sign"), *[zero[m].alias(f"_{m}") for m in measures]),
                F.struct(F.col("high").alias("at"), F.lit(1).alias("_sign"), *[F.coalesce(m, zero[m]).alias(f"_{m}") for m in measures]),
            )
        ),
    )
    ranged = materialize(
        ends.repartitionByRange("root", "at").withColumn("_part", F.spark_partition_id()), "walk"
    )
    # One line for each range; sums before a range are carried into it.
    parts = ranged.groupBy("_part").agg(*[F.sum(f"_{m}").cast(wide[m]).alias(f"_{m}") for m in measures])
    carried: dict[str, object] = {m: 0 for m in measures}
    lines = []
    for line in sorted(parts.collect(), key=lambda r: r["_part"]):
        lines.append((line["_part"], *[str(carried[m]) for m in measures]))
        carried = {m: carried[m] + line[f"_{m}"] for m in measures}
    schema = ", ".join(["_part int", *[f"_before_{m} string" for m in measures]])
    before = rows.sparkSession.createDataFrame(lines, schema)
    upto = Window.partitionBy("_part").orderBy("root", "at").rowsBetween(Window.unboundedPreceding, 0)
    running = {m: (F.sum(f"_{m}").over(upto) + F.col(f"_before_{m}").cast(wide[m])).cast(wide[m]) for m in measures}
    walked = ranged.join(before, "_part").select(key, "_sign", *[running[m].alias(f"_{m}") for m in measures])
    return walked.groupBy(key).agg(
        *[F.sum((F.col(f"_{m}") * F.col("_sign")).cast(wide[m])).cast(wide[m]).alias(m) for m in measures]
    )
