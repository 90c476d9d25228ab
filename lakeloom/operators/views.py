"""Views kept up to date by the changes of their tables.

A change of a table is a table of rows with a signed multiplicity ``_m``: 1 for a row that
came, -1 for one that went; an update is both. Rules carry changes through a query:

- filters, columns and unions treat changed rows like others;
- a join's change is the change of the left side joined with the *new* right side, plus the
  *old* left side joined with the change of the right side, multiplicities multiplied;
- sums and counts add the signed sums of the change to what is kept, per group;
- smallest and largest values need the values that are left when one goes, so a view keeps
  the values of its groups with their number.

A view is stored by partition. A batch reads and writes the partitions that it touches and
no others; a partition remembers the last batch it has, so that a batch that is applied
again after a failure changes only the partitions it had not reached.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import materialize

M = "_m"
BATCH = "_batch"
ROWS = "_rows"


def signed(came: DataFrame | None = None, went: DataFrame | None = None) -> DataFrame:
    """The change that adds the first rows and takes away the second."""
    parts = [df.withColumn(M, F.lit(m).cast("bigint")) for df, m in ((came, 1), (went, -1)) if df is not None]
    if not parts:
        raise ValueError("a change has rows that come or go")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


@dataclass(frozen=True)
class Changing:
    """A table before a batch, and the batch's change of it (None: none)."""

    old: DataFrame
    change: DataFrame | None = None

    def new(self) -> DataFrame:
        """The table after the batch, with multiplicities."""
        before = signed(self.old)
        return before if self.change is None else before.unionByName(self.change)

    def select(self, *columns: Column | str) -> Changing:
        changed = None if self.change is None else self.change.select(*columns, M)
        return Changing(self.old.select(*columns), changed)

    def join(self, other: Changing, on: str | Sequence[str]) -> Changing:
        """Inner join; both sides name the shared columns alike."""
        on = [on] if isinstance(on, str) else list(on)
        parts = []
        if self.change is not None:
            right = other.new().withColumnRenamed(M, "_m2")
            parts.append(self.change.join(right, on))
        if other.change is not None:
            left = signed(self.old)
            parts.append(left.join(other.change.withColumnRenamed(M, "_m2"), on))
        old = self.old.join(other.old, on)
        if not parts:
            return Changing(old)
        product = (F.col(M) * F.col("_m2")).alias(M)
        changed = [p.select(*old.columns, product) for p in parts]
        return Changing(old, changed[0] if len(changed) == 1 else changed[0].unionByName(changed[1]))


@dataclass(frozen=True)
class GroupedView:
    """Sums and counts per group, stored by partition and changed by batches.

    ``sums`` names the sums of columns, ``counts`` the numbers of rows in which a column is
    not NULL; both are kept exactly (decimals and whole numbers). ``partition`` are key
    columns of whole numbers or dates, or none: then keys fall into ``buckets`` by hash. One
    writer at a time.
    """

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    sums: Mapping[str, str]
    counts: Mapping[str, str]
    partition: tuple[str, ...] = ()
    buckets: int = 64

    def _bucketed(self, df: DataFrame) -> DataFrame:
        if self.partition:
            return df
        return df.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    @property
    def _parts(self) -> list[str]:
        return list(self.partition) or ["_bucket"]

    def _stored(self) -> DataFrame | None:
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self._parts[0]}=*")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.globStatus(pattern):
            return None
        return self.spark.read.parquet(self.root)

    def summed(self, change: DataFrame) -> DataFrame:
        """The change per group: signed sums, counts and number of rows."""
        measures = [F.sum(F.col(c) * F.col(M)).alias(n) for n, c in self.sums.items()]
        measures += [
            F.sum(F.when(F.col(c).isNotNull(), F.col(M)).otherwise(F.lit(0).cast("bigint"))).alias(n)
            for n, c in self.counts.items()
        ]
        return change.groupBy(*self.keys).agg(*measures, F.sum(M).alias(ROWS))

    def _names(self) -> list[str]:
        return [*self.sums, *self.counts, ROWS]

    def apply(self, change: DataFrame, batch: int) -> list[tuple]:
        """Apply a batch's change; returns the partitions that were written.

        Batches are numbered upwards; one that a partition has already is left out there.
        """
        totals = materialize(self._bucketed(self.summed(change)), "view")
        # One row a partition of the view.
        touched = {tuple(r) for r in totals.select(*self._parts).distinct().collect()}
        stored = self._stored()
        rows = totals.select(*self.keys, *self._parts_only(), *self._typed(totals))
        if stored is not None and touched:
            held = stored.filter(self._among(touched))
            last = held.groupBy(*self._parts).agg(F.max(BATCH).alias("b")).collect()
            done = {tuple(r)[:-1] for r in last if r["b"] >= batch}
            touched -= done
            held = held.select(*self.keys, *self._parts_only(), *self._names())
            rows = held.unionByName(rows).filter(self._among(touched)) if touched else rows.limit(0)
        if not touched:
            return []
        # A group without rows stays as a line of zeros, so that its partition is written.
        merged = rows.groupBy(*self.keys, *self._parts_only()).agg(
            *[F.sum(n).alias(n) for n in self._names()]
        )
        fields = self._typed(totals)
        merged = merged.select(*self.keys, *self._parts_only(), *fields, F.lit(batch).cast("bigint").alias(BATCH))
        # Partitions that are read and written again go through the shared folder.
        written = materialize(merged, "view")
        (
            written.hint("rebalance", *self._parts)
            .write.partitionBy(*self._parts)
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(self.root)
        )
        return sorted(touched, key=repr)

    def _parts_only(self) -> list[str]:
        return [p for p in self._parts if p not in self.keys]

    def _typed(self, totals: DataFrame) -> list[Column]:
        """Sums keep one width however often they are added up."""
        kinds = {f.name: f.dataType for f in totals.schema.fields}
        wide = {
            n: f"decimal(38,{k.scale})" if isinstance(k, T.DecimalType) else "bigint"
            for n, k in kinds.items()
            if n in self._names()
        }
        return [F.col(n).cast(wide[n]).alias(n) for n in self._names()]

    def _among(self, parts: set[tuple]) -> Column:
        """A filter on partition columns, so that other partitions are not listed or read."""
        if len(self._parts) == 1:
            column, values = F.col(self._parts[0]), [p[0] for p in parts]
            known = [v for v in values if v is not None]
            found = column.isin(known) if known else F.lit(False)
            return found | column.isNull() if None in values else found
        found = F.lit(False)
        by_first: dict[object, set[tuple]] = {}
        for p in parts:
            by_first.setdefault(p[0], set()).add(p[1:])
        for first, rest in by_first.items():
            inner = GroupedView(self.spark, self.root, self.keys, {}, {}, tuple(self._parts[1:]))
            found = found | (F.col(self._parts[0]).eqNullSafe(F.lit(first)) & inner._among(rest))
        return found

    def read(self) -> DataFrame:
        """Groups that have rows, with ``_rows``; a sum over no values is NULL."""
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"no batch was applied below {self.root}")
        counted = {c: n for n, c in self.counts.items()}
        sums = [
            F.when(F.col(counted[c]) > 0, F.col(n)).alias(n) if c in counted else F.col(n)
            for n, c in self.sums.items()
        ]
        return stored.filter(F.col(ROWS) > 0).select(*self.keys, *sums, *self.counts, ROWS)


@dataclass(frozen=True)
class ExtremesView:
    """Smallest and largest value per group, from a kept multiset of the values."""

    values: GroupedView
    key: str
    column: str

    @staticmethod
    def of(spark: SparkSession, root: str, key: str, column: str, buckets: int = 64) -> ExtremesView:
        """The values lie by bucket of the key, so that a key's values lie together."""
        view = GroupedView(spark, root, ("_bucket", key, column), {}, {}, ("_bucket",), buckets)
        return ExtremesView(view, key, column)

    def apply(self, change: DataFrame, batch: int) -> list[tuple]:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.values.buckets)).cast("int")
        rows = change.filter(F.col(self.column).isNotNull())
        return self.values.apply(rows.withColumn("_bucket", bucket), batch)

    def read(self, least: str, greatest: str) -> DataFrame:
        kept = self.values.read()
        return kept.groupBy(self.key).agg(
            F.min(self.column).alias(least), F.max(self.column).alias(greatest)
        )
