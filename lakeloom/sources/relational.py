"""Table-wise import from relational sources.

Every source offers ``read(table)`` and ``tables()``. Row filters and column
lists are applied to the lazy table, so Spark pushes them into the scan: into
the remote SQL for JDBC, into the file reader for Parquet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    """A database reached over JDBC. Credentials come from the caller only."""

    url: str
    driver: str
    properties: Mapping[str, str] = field(default_factory=dict)
    names: Sequence[str] = ()
    fetch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_rows),
        }

    def tables(self) -> list[str]:
        return list(self.names)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole table through one connection."""
        return spark.read.format("jdbc").options(**self.options()).option("dbtable", table).load()

    def split_options(self, lower: object, upper: object, column: str, parts: int) -> dict[str, str]:
        """Options of a scan by ``parts`` connections, cut on a column's range."""
        return {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }

    def bounds_query(self, table: str, column: str) -> str:
        """What the database is asked for the ends of a column: one row comes back."""
        return f"(select min({column}) as lo, max({column}) as hi from {table}) bounds"

    def read_split(self, spark: SparkSession, table: str, column: str, parts: int) -> DataFrame:
        """The whole table through several connections.

        The bounds are a query of their own that the database answers with one row; they
        only balance the connections, rows outside them (and NULLs) are read as well.
        """
        ends = self.read(spark, self.bounds_query(table, column)).first()
        if ends is None or ends[0] is None:
            return self.read(spark, table)
        return (
            spark.read.format("jdbc")
            .options(**self.options(), **self.split_options(ends[0], ends[1], column, parts))
            .option("dbtable", table)
            .load()
        )

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", connections: int = 8) -> None:
        """Write a (small) result table; at most ``connections`` writers."""
        (
            df.write.format("jdbc")
            .options(**self.options())
            .option("dbtable", table)
            .option("numPartitions", str(connections))
            .option("batchsize", "10000")
            .mode(mode)
            .save()
        )


@dataclass(frozen=True)
class FolderSource:
    """A schema kept as one Parquet file or folder per table."""

    root: str
    names: Sequence[str] = ()
    suffix: str = ".parquet"

    def tables(self) -> list[str]:
        return list(self.names)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{table}{self.suffix}")

    def read_split(self, spark: SparkSession, table: str, column: str, parts: int) -> DataFrame:
        """Files are split by size as they are."""
        return self.read(spark, table)


@dataclass(frozen=True)
class FrameSource:
    """A schema of lazily built DataFrames."""

    frames: Mapping[str, Callable[[], DataFrame] | DataFrame]

    def tables(self) -> list[str]:
        return list(self.frames)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        found = self.frames[table]
        return found() if callable(found) else found

    def read_split(self, spark: SparkSession, table: str, column: str, parts: int) -> DataFrame:
        """A DataFrame has its partitions already."""
        return self.read(spark, table)


def import_table(
    spark: SparkSession,
    source,
    table: str,
    where: Column | str | None = None,
    columns: Sequence[str] | None = None,
    split: tuple[str, int] | None = None,
) -> DataFrame:
    """One table, optionally with a row filter and a column list.

    ``split`` is the column and the number of connections to read a database table by.
    """
    df = source.read_split(spark, table, *split) if split else source.read(spark, table)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


@dataclass(frozen=True)
class TableStatus:
    """Outcome of one table of a multi-table job."""

    table: str
    ok: bool
    rows: int = 0
    path: str = ""
    error: str = ""


def for_each_table(
    tables: Sequence[str], job: Callable[[str], TableStatus], at_once: int = 4
) -> list[TableStatus]:
    """Run a job per table, ``at_once`` at a time; results in the order of the tables.

    A failing table is reported and does not stop the others. The jobs are only started
    side by side here; the session's scheduler shares out the executors.
    """

    def run(table: str) -> TableStatus:
        try:
            return job(table)
        except Exception as failure:  # reported per table, by design
            return TableStatus(table, ok=False, error=(str(failure).splitlines() or [""])[0])

    session = SparkSession.getActiveSession()
    target = inheritable_thread_target(session)(run) if session else run
    with ThreadPoolExecutor(max_workers=max(at_once, 1)) as pool:
        return list(pool.map(target, tables))


def import_all(
    spark: SparkSession,
    source,
    write: Callable[[DataFrame, str], TableStatus],
    tables: Sequence[str] | None = None,
    splits: Mapping[str, tuple[str, int]] | None = None,
    at_once: int = 4,
) -> list[TableStatus]:
    """Import every table of a source with one writer.

    ``splits`` names, per table, the column and number of connections to read it by; a
    table without one is read through one connection.
    """
    split = (splits or {}).get
    return for_each_table(
        list(tables or source.tables()),
        lambda t: write(import_table(spark, source, t, split=split(t)), t),
        at_once,
    )
