"""Batch jobs over the layers: land raw, clean, aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.operators.quality import TableRules, clean
from lakeloom.plans import marts
from lakeloom.sources.files import CORRUPT
from lakeloom.sources.lake import Lake
from lakeloom.sources.relational import TableStatus, for_each_table, import_all, import_table


def run_bronze(lake: Lake, source, tables: Sequence[str] | None = None,
               mode: str = "append", label: str = "import",
               splits: Mapping[str, tuple[str, int]] | None = None,
               at_once: int = 4) -> list[TableStatus]:
    """Land every table as raw JSON; a failing table does not stop the others.

    ``splits`` and ``at_once`` as in ``import_all``.
    """

    def land(df: DataFrame, table: str) -> TableStatus:
        done = lake.write_bronze(df, table, source=label, mode=mode)
        return TableStatus(table, ok=True, rows=done.rows, path=done.path)

    return import_all(lake.spark, source, land, tables, splits, at_once)


def run_silver(lake: Lake, schemas: Mapping[str, str | T.StructType],
               rules: Mapping[str, TableRules]) -> list[TableStatus]:
    """Clean every table that has rules; same error rule as the raw stage."""

    def refine(table: str) -> TableStatus:
        raw = lake.read_bronze(table, schemas[table]).drop(CORRUPT)
        done = lake.write_silver(clean(raw, rules[table]), table)
        return TableStatus(table, ok=True, rows=done.rows, path=done.path)

    return for_each_table(list(rules), refine)


GoldBuilder = Callable[[Callable[[str], DataFrame]], DataFrame]

# Business table -> (builder over the cleaned tables, partition columns, sort columns).
GOLD: dict[str, tuple[GoldBuilder, Sequence[str], Sequence[str]]] = {
    "monthly_revenue": (
        lambda t: marts.monthly_revenue(t("payment"), t("rental"), t("film")),
        ("year", "month"),
        ("rating",),
    ),
    "customer_lifetime_value": (
        lambda t: marts.customer_lifetime_value(t("customer"), t("payment"), t("rental")),
        (),
        (),
    ),
    "film_performance": (
        lambda t: marts.film_performance(t("rental"), t("film"), t("payment")),
        (),
        ("popularity_rank", "film_id"),
    ),
    "store_performance": (
        lambda t: marts.store_performance(t("rental"), t("payment")),
        ("year", "month"),
        ("store_id",),
    ),
}


def run_gold(lake: Lake, builders: Mapping[str, tuple] = GOLD, mode: str = "overwrite") -> list[TableStatus]:
    """Build the business tables from the cleaned layer; the first error stops."""

    def silver(table: str) -> DataFrame:
        df = lake.read_silver(table)
        if table == "rental" and "film_id" not in df.columns:
            return marts.rental_items(df, lake.read_silver("inventory"))
        return df

    out = []
    for name, (build, partition_cols, sort_by) in builders.items():
        done = lake.write_gold(build(silver), name, partition_cols, mode=mode, sort_by=sort_by)
        out.append(TableStatus(name, ok=True, rows=done.rows, path=done.path))
    return out


ACTIVE_COLUMNS = ("customer_id", "first_name", "last_name", "email", "store_id")


def run_demo(lake: Lake, source, table: str = "customer") -> DataFrame:
    """Small end-to-end run: extract, land as Parquet, keep active rows, read back."""
    raw_path = lake.path("bronze", f"{table}_parquet")
    import_table(lake.spark, source, table).write.mode("overwrite").parquet(raw_path)
    raw = lake.spark.read.parquet(raw_path)
    lake.write_silver(marts.active_customers(raw, ACTIVE_COLUMNS), f"{table}_active")
    return lake.read_silver(f"{table}_active")
