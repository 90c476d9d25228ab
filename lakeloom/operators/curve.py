"""A layout for filters on several columns, and what a filter really touches of it.

Rows are put in the order of a space-filling curve over the ranks of the columns, so that
each file holds a small box of all of them and its statistics exclude it for most filters.
Ranks come from quantiles (one pass over the columns, a sketch of fixed size each): the
columns' own spread does not matter, and a binary search among them needs no join.

The report reads footers only: Spark lists the files by a scan without columns, and tasks
open each file's footer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEEN = "_curve"


def _bounds(df: DataFrame, columns: Sequence[str], bits: int, accuracy: int) -> dict[str, list]:
    """Per column 2**bits - 1 quantiles in order (none for a column without values)."""
    parts = 2**bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = df.agg(*[F.percentile_approx(c, shares, F.lit(accuracy)).alias(c) for c in columns]).first()
    return {c: list(found[c] or []) for c in columns}


def _place(column: Column, bounds: Column, bits: int) -> Column:
    """How many of the ordered bounds are not above the value; NULL comes first."""

    def halve(low: Column, step: Column) -> Column:
        reached = F.get(bounds, low + step - 1) <= column
        return F.when(reached, low + step).otherwise(low)

    steps = F.array(*[F.lit(2**b) for b in reversed(range(bits))])
    return F.coalesce(F.aggregate(steps, F.lit(0), halve), F.lit(0))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = 8, accuracy: int = 100_000) -> Column:
    """Place of a row on a curve that takes one bit of each column's rank in turn.

    ``columns`` are numbers, dates or times; ``bits`` times their number is at most 62. The
    quantiles are found when the plan is built. Equal values have equal ranks.
    """
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError(f"{bits} bits of {len(columns)} columns do not make a key of 1 to 62 bits")
    limits = _bounds(df, columns, bits, accuracy)
    key = F.lit(0).cast("bigint")
    for i, name in enumerate(columns):
        if not limits[name]:
            continue
        kind = df.schema[name].dataType
        bounds = F.lit(limits[name]).cast(f"array<{kind.simpleString()}>")
        rank = _place(F.col(name), bounds, bits).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return key


def write_curve(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 8, group_bytes: int | None = None
) -> None:
    """Write ``df`` as about ``files`` Parquet files of about equal size in curve order.

    Rows of one place are told apart by the columns and a hash of the whole row, so that a
    value of very many rows still spreads over files. The order within a file makes its row
    groups (``group_bytes``) small boxes too. ``df`` is read twice. Times with a zone have
    statistics only if the session's ``spark.sql.parquet.outputTimestampType`` is not INT96.
    """
    _write_sorted(df, path, [curve_key(df, columns, bits).alias(SEEN), *map(F.col, columns)], files, group_bytes)


def write_ordered(df: DataFrame, path: str, columns: Sequence[str], files: int, group_bytes: int | None = None) -> None:
    """The same by the plain order of the columns, to compare layouts."""
    _write_sorted(df, path, [F.lit(0).alias(SEEN), *map(F.col, columns)], files, group_bytes)


def _write_sorted(df: DataFrame, path: str, order: Sequence[Column], files: int, group_bytes: int | None) -> None:
    place, *rest = order
    hashed = [c.name for c in df.schema.fields if "map<" not in c.dataType.simpleString()]
    by = [SEEN, *rest, F.xxhash64(*[F.col(f"`{c}`") for c in hashed])]
    placed = df.withColumn(SEEN, place).repartitionByRange(files, *by).sortWithinPartitions(SEEN, *rest)
    options = {"parquet.block.size": group_bytes} if group_bytes else {}
    placed.drop(SEEN).write.options(**options).parquet(path)


def _plain(value: Any) -> Any:
    """Statistics and literals in one form: times without a zone, in UTC; text as bytes."""
    if isinstance(value, dt.datetime):
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return value.encode() if isinstance(value, str) else value


def _can_match(group: Any, places: Mapping[str, int], wanted: Mapping[str, tuple]) -> bool:
    """Whether statistics leave open that a row of the group meets all ranges."""
    for column, (low, high) in wanted.items():
        if column not in places:
            continue
        known = group.column(places[column]).statistics
        if known is None:
            continue
        if known.has_null_count and known.null_count == group.num_rows:
            return False
        if not known.has_min_max:
            continue
        if low is not None and _plain(known.max) < _plain(low):
            return False
        if high is not None and _plain(known.min) > _plain(high):
            return False
    return True


def footers(spark: SparkSession, path: str, probes: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """``file, row_group, n_rows, probe, touched`` for every row group and probe.

    A probe names columns with their lowest and highest wanted value (None: open). A group
    without statistics counts as touched, as a reader could not leave it out. Partition
    columns are not in footers; they prune folders before.
    """
    stored = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"))
    names = stored.distinct()
    ranges = {name: dict(wanted) for name, wanted in probes.items()}

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for name in batch["file"]:
                store, inner = fs.FileSystem.from_uri(name)
                with store.open_input_file(inner) as opened:
                    footer = pq.ParquetFile(opened).metadata
                places = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    rows += [(name, g, group.num_rows, p, _can_match(group, places, w)) for p, w in ranges.items()]
            yield pd.DataFrame(rows, columns=["file", "row_group", "n_rows", "probe", "touched"])

    return names.mapInPandas(read, "file string, row_group int, n_rows bigint, probe string, touched boolean")


def touched(spark: SparkSession, path: str, probes: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """Per probe: files, row groups and rows there are, and those that it would read."""
    groups = footers(spark, path, probes)
    files = groups.groupBy("probe", "file").agg(
        F.max("touched").alias("_hit"),
        F.count("*").alias("_groups"),
        F.count_if("touched").alias("_groups_hit"),
        F.sum("n_rows").alias("_rows"),
        F.sum(F.when(F.col("touched"), F.col("n_rows")).otherwise(0)).alias("_rows_hit"),
    )
    return files.groupBy("probe").agg(
        F.count("*").alias("files"),
        F.count_if("_hit").alias("files_touched"),
        F.sum("_groups").alias("row_groups"),
        F.sum("_groups_hit").alias("row_groups_touched"),
        F.sum("_rows").alias("n_rows"),
        F.sum("_rows_hit").alias("rows_touched"),
    )
