"""Declarative cleaning rules, quality reports and constraint checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.dates import fractional_days
from lakeloom.functions.text import is_email
from lakeloom.operators.ranking import latest_by_key

REASON = "_reject_reason"


@dataclass(frozen=True)
class TableRules:
    """How one table is cleaned.

    ``derive`` runs first, in order; ``valid`` names the conditions a row must
    meet (a NULL condition counts as failed); of the valid rows the newest one
    per key stays.
    """

    key: tuple[str, ...]
    derive: dict[str, Column] = field(default_factory=dict)
    valid: dict[str, Column] = field(default_factory=dict)
    newest: tuple[str, ...] = ("last_update",)


def _required(*columns: str) -> dict[str, Column]:
    return {f"{c}_missing": F.col(c).isNotNull() for c in columns}


def default_rules() -> dict[str, TableRules]:
    """Rules of the rental-store tables."""
    return {
        "customer": TableRules(
            key=("customer_id",),
            derive={
                "first_name": F.trim("first_name"),
                "last_name": F.trim("last_name"),
                "email": F.lower(F.trim("email")),
                "active": F.coalesce("active", F.lit(True)),
            },
            valid={**_required("customer_id"), "email_invalid": is_email(F.col("email"))},
        ),
        "rental": TableRules(
            key=("rental_id",),
            derive={
                "rental_duration_days": fractional_days(F.col("return_date"), F.col("rental_date"))
            },
            valid=_required("rental_id", "customer_id", "rental_date"),
        ),
        "payment": TableRules(
            key=("payment_id",),
            valid={
                **_required("payment_id", "amount"),
                "amount_not_positive": F.col("amount") > 0,
            },
        ),
        "film": TableRules(
            key=("film_id",),
            derive={
                "title": F.trim("title"),
                "rating": F.upper(F.trim(F.coalesce("rating", F.lit("G")))),
            },
            valid=_required("film_id", "title"),
        ),
        "category": TableRules(
            key=("category_id",),
            derive={"name": F.trim("name")},
            valid=_required("category_id"),
        ),
        "inventory": TableRules(
            key=("inventory_id",), valid=_required("inventory_id", "film_id")
        ),
    }


def _failed(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _derived(df: DataFrame, rules: TableRules) -> DataFrame:
    return df.withColumns(rules.derive) if rules.derive else df


def _dedupe(df: DataFrame, rules: TableRules) -> DataFrame:
    return latest_by_key(df, rules.key, [c for c in rules.newest if c in df.columns])


def clean(df: DataFrame, rules: TableRules) -> DataFrame:
    """Valid rows only, newest per key. Invalid rows never reach the shuffle."""
    out = _derived(df, rules)
    for condition in rules.valid.values():
        out = out.filter(condition)
    return _dedupe(out, rules)


def label_rows(df: DataFrame, rules: TableRules) -> DataFrame:
    """Add the name of the first failed rule, or NULL for a valid row."""
    reason = F.coalesce(
        *[F.when(_failed(c), F.lit(name)) for name, c in rules.valid.items()], F.lit(None)
    )
    return _derived(df, rules).withColumn(REASON, reason)


def split_valid(df: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (before removing duplicates) and rejected rows with a reason."""
    labelled = label_rows(df, rules)
    accepted = labelled.filter(F.col(REASON).isNull()).drop(REASON)
    return accepted, labelled.filter(F.col(REASON).isNotNull())


def quality_report(df: DataFrame, rules: TableRules, table: str) -> DataFrame:
    """One row: rows read, kept and dropped, and failures per rule, in one pass.

    Rows are first counted per key, so the number of keys (= kept rows) and all
    counts come out of a single shuffle of small partial counts.
    """
    labelled = _derived(df, rules)
    failures = {f"failed_{n}": _failed(c).cast("bigint") for n, c in rules.valid.items()}
    ok = F.lit(1).cast("bigint")
    for condition in rules.valid.values():
        ok = ok * F.coalesce(condition.cast("bigint"), F.lit(0))
    per_key = labelled.groupBy(*rules.key).agg(
        F.count("*").alias("_rows"),
        F.sum(ok).alias("_valid"),
        *[F.sum(c).alias(n) for n, c in failures.items()],
    )
    total = per_key.agg(
        F.sum("_rows").alias("rows_in"),
        F.sum("_valid").alias("rows_valid"),
        F.count_if(F.col("_valid") > 0).alias("rows_out"),
        *[F.sum(n).alias(n) for n in failures],
    )
    return total.select(
        F.lit(table).alias("table_name"),
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"),
        (F.col("rows_valid") - F.col("rows_out")).alias("duplicates"),
        *failures,
    )


def find_orphans(child: DataFrame, parent: DataFrame, child_key: Sequence[str],
                 parent_key: Sequence[str]) -> DataFrame:
    """Child rows whose (fully non-NULL) foreign key has no parent row."""
    known = parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(parent_key)])
    match = [F.col(c) == F.col(f"_pk{i}") for i, c in enumerate(child_key)]
    return child.dropna(subset=list(child_key)).join(known, match, "left_anti")


def check_fk(child: DataFrame, parent: DataFrame, child_key: Sequence[str],
             parent_key: Sequence[str], relation: str) -> DataFrame:
    """One row: orphan rows and distinct orphan keys of a relation.

    Child keys are counted first, so a hot key is one row in the join.
    """
    counted = child.groupBy(*child_key).agg(F.count("*").alias("_n"))
    lost = find_orphans(counted, parent, child_key, parent_key)
    return lost.agg(
        F.lit(relation).alias("relation"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    )


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def check_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed list (NULL is allowed), with their counts."""
    return (
        df.filter(~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )


def check_columns(df: DataFrame, not_null: Sequence[str] = (),
                  max_length: dict[str, int] | None = None) -> DataFrame:
    """One row of violation counts: NULLs in required columns and over-long texts."""
    checks = {f"{c}_null": F.col(c).isNull() for c in not_null}
    for column, limit in (max_length or {}).items():
        checks[f"{column}_too_long"] = F.length(column) > limit
    return df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])


def apply_fk_delete(child: DataFrame, deleted: DataFrame, child_key: str, parent_key: str,
                    rule: str) -> DataFrame:
    """Child table after a batch of parents was deleted.

    ``cascade`` removes the children, ``set_null`` clears their reference,
    ``restrict`` returns the children that forbid the delete.
    """
    gone = deleted.select(F.col(parent_key).alias("_gone")).distinct()
    match = F.col(child_key) == F.col("_gone")
    if rule == "cascade":
        return child.join(gone, match, "left_anti")
    if rule == "restrict":
        return child.join(gone, match, "left_semi")
    if rule == "set_null":
        kept = F.when(F.col("_gone").isNull(), F.col(child_key))
        return child.join(gone, match, "left").withColumn(child_key, kept).drop("_gone")
    raise ValueError(f"unknown rule {rule!r}")


def apply_fk_update(child: DataFrame, rekeyed: DataFrame, child_key: str, old_key: str,
                    new_key: str, rule: str = "cascade") -> DataFrame:
    """Child table after parents got a new key (``rekeyed`` maps old to new)."""
    moves = rekeyed.select(F.col(old_key).alias("_old"), F.col(new_key).alias("_new"))
    match = F.col(child_key) == F.col("_old")
    if rule == "restrict":
        return child.join(moves.select("_old"), match, "left_semi")
    if rule not in ("cascade", "set_null"):
        raise ValueError(f"unknown rule {rule!r}")
    target = F.col("_new") if rule == "cascade" else F.lit(None)
    moved = F.when(F.col("_old").isNotNull(), target).otherwise(F.col(child_key))
    return child.join(moves, match, "left").withColumn(child_key, moved).drop("_old", "_new")


def conform(df: DataFrame, schema: T.StructType, bad: str = "_bad_columns") -> DataFrame:
    """Give a loosely typed table the contract's columns and types.

    Values that cannot be converted become NULL and their column names are
    listed in ``bad``; missing columns are added as NULL, extra ones dropped.
    """
    present = set(df.columns)
    typed, failed = [], []
    for f in schema.fields:
        if f.name not in present:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f.name).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        failed.append(F.when(F.col(f.name).isNotNull() & value.isNull(), F.lit(f.name)))
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.select(*typed, names.alias(bad))
