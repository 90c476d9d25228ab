"""Keys that nobody declared, found from the data: references and unique column sets.

References. A column refers to another if all its values are among the other's. All values
of all columns are turned round once, to the set of columns each value is in (a bit a
column, so that equal values are one row before anything is shuffled); few different sets
are left, and a column's possible targets are what all sets with it have in common.

Unique sets. Column sets are tried from small to large, and supersets of unique sets are
not tried at all. A set is unique if no combination of its values is counted twice. Equal
rows have equal hashes, so the rows are cut into slices by the hash of the set's values and
no repetition spans two of them: the first slice shows the repetitions of most sets that
have any, and a set without is counted over all the other slices, to the last row. Rows are
counted in each task before they are shuffled: a combination of very many rows is one line.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import materialize

MOST_COLUMNS = 63  # bits of a set of columns
SLICES = 16  # parts of a table that are looked at for repeated rows one after the other


def _comparable(field: T.StructField) -> Column | None:
    """A value as text that equals another's if the values do, whatever their width."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.IntegralType):
        return F.concat(F.lit("n"), column.cast("string"))
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit(kind.typeName()[0]), column.cast("string"))
    return None


def inclusions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``child_table, child, parent_table, parent, n_values`` of all references.

    ``n_values`` counts the child's distinct values; NULL refers to nothing, and a column
    without values is left out on both sides. Compared are whole numbers with whole
    numbers, texts with texts and times with times of their type.
    """
    columns = []
    for table, df in tables.items():
        columns += [(table, f.name, c) for f in df.schema.fields if (c := _comparable(f)) is not None]
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"at most {MOST_COLUMNS} columns at a time")
    number = {(t, c): i for i, (t, c, _) in enumerate(columns)}
    parts = []
    for table, df in tables.items():
        own = [(number[t, c], value) for t, c, value in columns if t == table]
        pairs = [F.struct(F.lit(1 << i).cast("bigint").alias("bit"), v.alias("value")) for i, v in own]
        if pairs:
            parts.append(df.select(F.inline(F.array(*pairs))).filter("value is not null"))
    spark = next(iter(tables.values())).sparkSession
    if not parts:
        raise ValueError("no column can be compared")
    values = parts[0]
    for more in parts[1:]:
        values = values.unionByName(more)
    sets = values.groupBy("value").agg(F.bit_or("bit").alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    of_column = [F.struct(F.lit(i).alias("i"), F.lit(1 << i).cast("bigint").alias("bit")) for i in range(len(columns))]
    common = (
        sets.select("mask", "n", F.inline(F.array(*of_column)))
        .filter(F.col("mask").bitwiseAND(F.col("bit")) != 0)
        .groupBy("i")
        .agg(F.bit_and("mask").alias("common"), F.sum("n").alias("n_values"))
    )
    def named(table: str, column: str, i: str) -> DataFrame:
        rows = [(i, t, c) for i, (t, c, _) in enumerate(columns)]
        return spark.createDataFrame(rows, f"{i} int, {table} string, {column} string")

    # At most one row a column on either side.
    targets = F.filter(
        F.array(*of_column), lambda c: (F.col("common").bitwiseAND(c["bit"]) != 0) & (c["i"] != F.col("_child"))
    )
    return (
        common.withColumnRenamed("i", "_child")
        .select("_child", "n_values", F.inline(targets).alias("_parent", "_bit"))
        .join(named("child_table", "child", "_child"), "_child")
        .join(named("parent_table", "parent", "_parent"), "_parent")
        .select("child_table", "child", "parent_table", "parent", "n_values")
    )


def unique_sets(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3) -> DataFrame:
    """``columns``: the minimal sets of at most ``most`` columns with no two equal rows.

    Sets are arrays in the table's order of columns. NULL counts as a value. A table
    without rows, or with one, is unique by any column.
    """
    names = list(columns or df.columns)
    spark = df.sparkSession
    base = materialize(df.select(*[_countable(df.schema[c]) for c in names]), "lattice")
    found: list[tuple[str, ...]] = []
    broken: set[tuple[str, ...]] = {()}
    for size in range(1, most + 1):
        tried = [
            c for c in combinations(names, size)
            if c[:-1] in broken and not any(set(u) <= set(c) for u in found)
        ]
        if not tried:
            break
        clash = _repeated(base, tried, first=True)
        clash |= _repeated(base, [c for c in tried if c not in clash], first=False)
        found += [c for c in tried if c not in clash]
        broken = clash
    return spark.createDataFrame([(list(c),) for c in found], "columns array<string>")


def _countable(field: T.StructField) -> Column:
    """The column; as JSON if rows cannot be grouped by its type."""
    column = F.col(f"`{field.name}`")
    if re.search("map<|variant", field.dataType.simpleString()):
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"}).alias(field.name)
    return column


def _repeated(base: DataFrame, sets: Sequence[tuple[str, ...]], first: bool) -> set[tuple[str, ...]]:
    """The column sets with two equal rows in the first slice, or in any of the others."""
    repeated = None
    for i, c in enumerate(sets):
        values = [F.col(f"`{x}`") for x in c]
        place = F.pmod(F.xxhash64(*values), F.lit(SLICES))
        counts = base.filter(place == 0 if first else place != 0).groupBy(*values).agg(F.count("*").alias("_n"))
        part = counts.filter("_n > 1").select(F.lit(i).alias("_set")).distinct()
        repeated = part if repeated is None else repeated.unionByName(part)
    # One row a column set.
    return {sets[r["_set"]] for r in repeated.collect()} if sets else set()
