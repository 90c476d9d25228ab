"""Deletes through a whole graph of foreign keys.

Rows that a delete reaches are found as a fixed point over all cascading relations, self
references and cycles included: each round takes the children of the rows found last, as
sets of distinct keys, so that a row is followed once however many ways lead to it. A row
that a RESTRICT relation holds vetoes everything above it, up to the rows that were to be
deleted; that is a second fixed point, upwards. What is deleted is then reached anew from
the rows without veto, so a row below both a vetoed and a free one goes with the free one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import materialize_counted

CASCADE, RESTRICT, SET_NULL = "cascade", "restrict", "set_null"


@dataclass(frozen=True)
class Relation:
    """``child.columns`` refer to the primary key of ``parent``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    rule: str

    def __post_init__(self):
        if self.rule not in (CASCADE, RESTRICT, SET_NULL):
            raise ValueError(f"unknown rule {self.rule!r}")


@dataclass(frozen=True)
class Schema:
    """Tables, their primary keys and the relations between them."""

    tables: Mapping[str, DataFrame]
    keys: Mapping[str, tuple[str, ...]]
    relations: Sequence[Relation]

    def children(self, parent: str, rule: str) -> list[Relation]:
        return [r for r in self.relations if r.parent == parent and r.rule == rule]

    def referring(self, relation: Relation, parents: DataFrame) -> DataFrame:
        """Rows of the child table that refer to some parents."""
        keys = self.keys[relation.parent]
        wanted = parents.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)])
        match = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(relation.columns)]
        return self.tables[relation.child].join(wanted, match, "left_semi")

    def referred(self, relation: Relation, children: DataFrame) -> DataFrame:
        """Keys of the parents that some child rows (given by key) refer to."""
        own = list(self.keys[relation.child])
        rows = self.tables[relation.child].select(
            *own, *[F.col(c).alias(f"_r{i}") for i, c in enumerate(relation.columns)]
        )
        keys = self.keys[relation.parent]
        return rows.join(children, own, "left_semi").select(
            *[F.col(f"_r{i}").alias(k) for i, k in enumerate(keys)]
        )


class Found:
    """Distinct keys per table, growing by rounds that are written once."""

    def __init__(self, schema: Schema):
        self.schema = schema
        self.rounds: dict[str, list[DataFrame]] = {}

    def keys(self, table: str) -> DataFrame | None:
        parts = self.rounds.get(table)
        if not parts:
            return None
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def add(self, table: str, keys: list[DataFrame]) -> DataFrame | None:
        """The keys that were not found before; None if there are none."""
        new = keys[0]
        for more in keys[1:]:
            new = new.unionByName(more)
        own = list(self.schema.keys[table])
        new = new.dropna(subset=own).distinct()
        known = self.keys(table)
        if known is not None:
            new = new.join(known, own, "left_anti")
        new, n = materialize_counted(new, "cascade")
        if not n:
            return None
        self.rounds.setdefault(table, []).append(new)
        return new


def _below(schema: Schema, table: str, rows: DataFrame) -> Found:
    """All rows that deleting some rows reaches by cascades, these included."""
    found = Found(schema)
    own = schema.tables[table].select(*schema.keys[table])
    start = found.add(table, [own.join(rows.select(*schema.keys[table]), list(schema.keys[table]), "left_semi")])
    front = {} if start is None else {table: start}
    while front:
        reached: dict[str, list[DataFrame]] = {}
        for parent, keys in front.items():
            for r in schema.children(parent, CASCADE):
                children = schema.referring(r, keys).select(*schema.keys[r.child])
                reached.setdefault(r.child, []).append(children)
        added = {t: found.add(t, keys) for t, keys in reached.items()}
        front = {t: keys for t, keys in added.items() if keys is not None}
    return found


def _held(schema: Schema, found: Found) -> Found:
    """Found rows that are held by a RESTRICT relation, or have such a row below them."""
    held = Found(schema)
    front = {}
    for table in list(found.rounds):
        holding = []
        for r in schema.children(table, RESTRICT):
            named = [F.col(c).alias(k) for c, k in zip(r.columns, schema.keys[table])]
            referred = schema.tables[r.child].select(*named)
            holding.append(found.keys(table).join(referred, list(schema.keys[table]), "left_semi"))
        keys = held.add(table, holding) if holding else None
        if keys is not None:
            front[table] = keys
    while front:
        reached: dict[str, list[DataFrame]] = {}
        for r in schema.relations:
            if r.rule == CASCADE and r.child in front and r.parent in found.rounds:
                above = schema.referred(r, front[r.child])
                above = above.join(found.keys(r.parent), list(schema.keys[r.parent]), "left_semi")
                reached.setdefault(r.parent, []).append(above)
        added = {t: held.add(t, keys) for t, keys in reached.items()}
        front = {t: keys for t, keys in added.items() if keys is not None}
    return held


@dataclass(frozen=True)
class Deleted:
    """Tables after a delete, keys that went by table, and root rows that were vetoed."""

    tables: dict[str, DataFrame]
    keys: dict[str, DataFrame]
    vetoed: DataFrame | None = field(default=None)


def delete(schema: Schema, table: str, rows: DataFrame) -> Deleted:
    """Delete the rows of ``table`` whose keys are in ``rows``, with all that follows.

    Every row to delete stands for itself: one that is vetoed stays with all that only it
    would have taken along, the others go. A RESTRICT reference vetoes even if the row it
    comes from would go by another way. References of deleted rows by SET NULL relations
    become NULL. NULL references refer to nothing; keys that the table lacks are ignored.
    The number of rounds is the length of the longest cascade.
    """
    reached = _below(schema, table, rows)
    held = _held(schema, reached)
    vetoed = held.keys(table)
    own = list(schema.keys[table])
    free = rows.select(*own)
    if vetoed is not None:
        free = free.join(vetoed, own, "left_anti")
        vetoed = vetoed.join(rows.select(*own).distinct(), own, "left_semi")
        gone = _below(schema, table, free)
    else:
        gone = reached
    keys = {t: gone.keys(t) for t in gone.rounds}
    left = dict(schema.tables)
    for r in schema.relations:
        if r.rule == SET_NULL and r.parent in keys:
            wanted = keys[r.parent].select(
                *[F.col(k).alias(f"_p{i}") for i, k in enumerate(schema.keys[r.parent])],
                F.lit(True).alias("_gone"),
            )
            match = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(r.columns)]
            joined = left[r.child].join(wanted, match, "left")
            cleared = {c: F.when(F.col("_gone").isNull(), F.col(c)) for c in r.columns}
            left[r.child] = joined.withColumns(cleared).select(*left[r.child].columns)
    for t, found in keys.items():
        left[t] = left[t].join(found, list(schema.keys[t]), "left_anti")
    return Deleted(left, keys, vetoed)
