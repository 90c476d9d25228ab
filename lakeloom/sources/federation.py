"""Several systems under qualified names in one SQL text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakeloom.session import scratch_path

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


MADE_HERE = "lakeloom.registered"


def register_folders(spark: SparkSession, system: str, folders: Mapping[str, str]) -> None:
    """Make Parquet folders available as ``system.table`` (external tables).

    A table of that name that was not registered here is an error and stays untouched;
    one registered here is pointed to the new folder, its old folder stays. Concurrent jobs
    should each use a system name of their own (``unused_system``).
    """
    location = scratch_path(spark, f"catalog-{system}")
    spark.sql(f"create database if not exists `{system}` location '{location}'")
    for table, path in folders.items():
        if spark.catalog.tableExists(f"`{system}`.`{table}`"):
            told = spark.sql(f"show tblproperties `{system}`.`{table}`").collect()
            if (MADE_HERE, "true") not in {(r["key"], r["value"]) for r in told}:
                raise ValueError(f"table {system}.{table} exists and was not registered here")
            spark.sql(f"drop table `{system}`.`{table}`")  # external: its files stay
        spark.sql(
            f"create table `{system}`.`{table}` using parquet location '{path}'"
            f" tblproperties ('{MADE_HERE}' = 'true')"
        )


def unused_system(label: str) -> str:
    """A system name that no other job uses."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


_registered_views: set[str] = set()


def register_frames(spark: SparkSession, system: str, frames: Mapping[str, DataFrame]) -> None:
    """Make DataFrames available as ``system_table`` views of this session.

    A view of that name that was not registered here is an error and stays untouched.
    """
    names = [f"{system}_{table}" for table in frames]
    foreign = [n for n in names if n not in _registered_views and spark.catalog.tableExists(n)]
    if foreign:
        raise ValueError(f"{', '.join(foreign)} exist and were not registered here")
    for name, df in zip(names, frames.values()):
        df.createOrReplaceTempView(name)
        _registered_views.add(name)


@contextmanager
def federated(
    spark: SparkSession,
    folders: Mapping[str, Mapping[str, str]],
    frames: Mapping[str, Mapping[str, DataFrame]],
) -> Iterator[dict[str, str]]:
    """Systems of folders and of frames for as long as queries are written over them.

    Gives the names under which each label's system is registered, which no other job
    uses. On leaving, databases and views made here are dropped; DataFrames made meanwhile
    stay valid, as their plans have the files, which stay.
    """
    names = {label: unused_system(label) for label in (*folders, *frames)}
    try:
        for label, tables in folders.items():
            register_folders(spark, names[label], tables)
        for label, tables in frames.items():
            register_frames(spark, names[label], tables)
        yield names
    finally:
        for label in folders:
            spark.sql(f"drop database if exists `{names[label]}` cascade")
        for label, tables in frames.items():
            for table in tables:
                view = f"{names[label]}_{table}"
                spark.catalog.dropTempView(view)
                _registered_views.discard(view)


def jdbc_catalog_settings(system: str, options: Mapping[str, str]) -> dict[str, str]:
    """Session settings that mount a live database as the catalog ``system``."""
    prefix = f"spark.sql.catalog.{system}"
    return {prefix: JDBC_CATALOG, **{f"{prefix}.{k}": v for k, v in options.items()}}


def register_jdbc(spark: SparkSession, system: str, options: Mapping[str, str]) -> None:
    """Mount a live database: ``system.schema.table`` in SQL, filters pushed down."""
    for key, value in jdbc_catalog_settings(system, options).items():
        spark.conf.set(key, value)
