"""What changed between two states of a table, by a tree of digests over key ranges.

A state is kept as rows of key and digest, in one folder per leaf: a leaf is a range of
keys, fixed by the first state and taken over by later ones. Above the leaves, each node
has a digest of its children's digests, ``FANOUT`` of them. Two states are compared from
the root: only below nodes that differ are digests looked at, and only leaves that differ
are read row by row. The cost of a comparison so grows with the change, not the table.

The digest of a leaf adds up over its rows in any order: their number, the exclusive or
of one 64-bit hash and the sum of another, so that it is one aggregate with partial sums.
Leaves hold about as many keys each, whatever their distribution, as the ranges are cut by
a sample of the first state; a table that has grown far past its ranges is cut anew by a
state without ``like``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FANOUT = 32
DEPTH = 2
KEY, DIGEST, LEAF = "_key", "_digest", "_leaf"


@dataclass(frozen=True)
class KeyTree:
    """A stored state of a table: ``rows`` by leaf, ``bounds`` of the leaves, ``nodes``."""

    spark: SparkSession
    root: str

    def rows(self) -> DataFrame:
        # A state without rows has no file that tells the columns.
        kind = self.bounds().schema[KEY].dataType.simpleString()
        schema = f"{KEY} {kind}, {DIGEST} string, {LEAF} int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/rows")

    def bounds(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/bounds")

    def nodes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/nodes")


def _struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def _leaf(key: Column, kind: str, bounds: list) -> Column:
    """Number of the leaf of a key: one comparison per child on the way down from the root.

    ``bounds`` are the first keys of all leaves but the first, in order, as JSON values.
    """
    branches = F.from_json(F.lit(json.dumps(bounds[FANOUT - 1 :: FANOUT])), f"array<{kind}>")
    inner = [bounds[i : i + FANOUT - 1] for i in range(0, max(len(bounds), 1), FANOUT)]
    inner = F.from_json(F.lit(json.dumps(inner)), f"array<array<{kind}>>")
    branch = F.size(F.filter(branches, lambda b: b <= key))
    below = F.filter(F.get(inner, branch), lambda b: b <= key)
    return branch * FANOUT + F.coalesce(F.size(below), F.lit(0))


def _cut(keyed: DataFrame, leaves: int) -> DataFrame:
    """First keys of ranges with about as many keys each (one row a range)."""
    ranged = keyed.select(KEY).repartitionByRange(leaves, KEY)
    first = ranged.groupBy(F.spark_partition_id().alias("_part")).agg(F.min(KEY).alias(KEY))
    return first.orderBy(KEY).offset(1).select(KEY)


def take_state(df: DataFrame, keys: Sequence[str], root: str, like: KeyTree | None = None,
               leaf_rows: int = 100_000) -> KeyTree:
    """Store the state of ``df`` below ``root``, with the key ranges of an earlier state.

    Keys should be unique; rows with equal keys count together and are told apart by their
    digests only. NULL keys are the least. A first state has a leaf for ``leaf_rows`` rows, at
    most ``FANOUT ** DEPTH`` of them.
    """
    spark = df.sparkSession
    others = sorted(c for c in df.columns if c not in keys)
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]), {"ignoreNullFields": "false"})
    keyed = df.select(_struct(keys).alias(KEY), F.sha2(content, 256).alias(DIGEST))
    tree = KeyTree(spark, root)
    if like:
        like.bounds().coalesce(1).write.parquet(f"{root}/bounds")
    else:
        leaves = min(-(-keyed.count() // leaf_rows), FANOUT**DEPTH)
        _cut(keyed, max(leaves, 1)).coalesce(1).write.parquet(f"{root}/bounds")
    # One list of at most FANOUT ** DEPTH keys.
    listed = tree.bounds().agg(F.to_json(F.array_sort(F.collect_list(KEY)))).first()[0]
    kind = keyed.schema[KEY].dataType.simpleString()
    (
        keyed.withColumn(LEAF, _leaf(F.col(KEY), kind, json.loads(listed)))
        .repartition(LEAF)
        .sortWithinPartitions(LEAF, KEY)
        .write.partitionBy(LEAF)
        .parquet(f"{root}/rows")
    )
    leaf = (
        tree.rows()
        .groupBy(F.col(LEAF).alias("node"))
        .agg(
            F.concat_ws(
                ":",
                F.count("*"),
                F.bit_xor(F.xxhash64(KEY, DIGEST)),
                F.sum(F.xxhash64(DIGEST, KEY).cast("decimal(38,0)")),
            ).alias("digest")
        )
        .select(F.lit(DEPTH).alias("level"), "node", "digest")
    )
    leaf.coalesce(1).write.parquet(f"{root}/nodes")
    for level in range(DEPTH - 1, -1, -1):
        below = tree.nodes().filter(F.col("level") == level + 1)
        (
            below.groupBy((F.col("node") / FANOUT).cast("int").alias("node"))
            .agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("node", "digest")))), 256).alias("digest"))
            .select(F.lit(level).alias("level"), "node", "digest")
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{root}/nodes")
        )
    return tree


def differing_leaves(before: KeyTree, after: KeyTree) -> list[int]:
    """Numbers of the leaves that differ, found from the root down."""
    if before.bounds().exceptAll(after.bounds()).count() or after.bounds().exceptAll(before.bounds()).count():
        raise ValueError("the states have different key ranges; take the later one like the earlier")
    open_nodes = [0]
    for level in range(DEPTH + 1):
        here = F.col("level") == level
        if level:
            # Children of the nodes that differ, and of no others.
            here = here & (F.col("node") / FANOUT).cast("int").isin(open_nodes)
        sides = [t.nodes().filter(here).select("node", F.col("digest").alias(n))
                 for t, n in ((before, "old"), (after, "new"))]
        unequal = sides[0].join(sides[1], "node", "full").filter(~F.col("old").eqNullSafe(F.col("new")))
        open_nodes = sorted(r["node"] for r in unequal.select("node").collect())
        if not open_nodes:
            return []
    return open_nodes


def changes(before: KeyTree, after: KeyTree, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``change``: the keys inserted, changed or deleted from one state to the next.

    Reads the rows of differing leaves only.
    """
    leaves = differing_leaves(before, after)
    old = before.rows().filter(F.col(LEAF).isin(leaves)).groupBy(KEY)
    new = after.rows().filter(F.col(LEAF).isin(leaves)).groupBy(KEY)
    # Rows of one key are one sorted list, so that repeated keys compare as a whole.
    listed = F.array_sort(F.collect_list(DIGEST))
    both = old.agg(listed.alias("_old")).join(
        new.agg(listed.alias("_new")).withColumnRenamed(KEY, "_other"),
        F.col(KEY).eqNullSafe(F.col("_other")),
        "full",
    )
    change = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(F.col("_old") != F.col("_new"), "changed")
    )
    key = F.when(F.col("_old").isNull(), F.col("_other")).otherwise(F.col(KEY))
    return (
        both.select(key.alias(KEY), change.alias("change"))
        .filter("change is not null")
        .select(*[F.col(f"{KEY}.k{i}").alias(k) for i, k in enumerate(keys)], "change")
    )
