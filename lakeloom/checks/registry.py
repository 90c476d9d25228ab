"""The register of queries and the SQL fragments their oracles share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans.binding import Domain
from lakeloom.session import tune


@dataclass(frozen=True)
class Check:
    """A query over the domain tables and, where SQL can express it, its oracle."""

    name: str
    build: Callable[[Domain], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(self.build(Domain(tune(spark), folder)))


REGISTRY: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register the decorated function under a name."""

    def register(build: Callable[[Domain], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Check(name, build, sql)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Types both engines print alike: bigint, double, text; times as text."""

    def plain(f: T.StructField):
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return column.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(f.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


# --- SQL fragments -----------------------------------------------------------

CTES = {
    "payment": """payment as (
        select o_orderkey as payment_id, o_orderkey as rental_id, o_custkey as customer_id,
               cast(o_totalprice as decimal(18,2)) as amount, o_orderdate as payment_date
        from orders)""",
    "rental": """rental as (
        select l_orderkey as rental_id, cast(l_linenumber as bigint) as line_number,
               l_partkey as film_id, l_suppkey as store_id,
               case when l_linestatus <> 'O' then cast(l_quantity as integer) end as days_kept,
               o_custkey as customer_id, o_orderdate as rental_date,
               case when l_linestatus <> 'O'
                    then o_orderdate + to_days(cast(l_quantity as integer)) end as return_date
        from lineitem join orders on l_orderkey = o_orderkey)""",
    "film": """film as (
        select p_partkey as film_id, p_name as title, p_type || ' ' || p_brand as description,
               p_brand as rating, cast(p_retailprice as decimal(18,2)) as rental_rate,
               cast(p_retailprice as decimal(18,2)) as replacement_cost,
               p_size as rental_duration, p_size as length
        from part)""",
    "film_category": """film_category as (
        select p_partkey as film_id, p_type as category from part
        union all
        select p_partkey, p_brand from part where p_size > 25)""",
    "cust": """cust as (
        select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) as last_name,
               '  C.' || split_part(c_name, '#', 2) || '@' || c_mktsegment || '.Example.com ' as email,
               cast(c_nationkey as bigint) as store_id, c_acctbal > 0 as active
        from customer)""",
    "customers": """customers as (
        select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
               split_part(c_name, '#', 2) as last_name, n_name as country
        from customer join nation on c_nationkey = n_nationkey)""",
    "inventory": """inventory as (
        select distinct l_partkey as film_id, l_suppkey as store_id from lineitem)""",
    "film_actor": """film_actor as (
        select distinct l_suppkey as actor_id, l_partkey as film_id from lineitem)""",
    "actor": """actor as (
        select s_suppkey as actor_id, upper(split_part(s_name, '#', 1)) as first_name,
               split_part(s_name, '#', 2) as last_name from supplier)""",
    "sales": """sales as (
        select p_name as product, p_type as category, cast(l_quantity as integer) as quantity,
               cast(l_extendedprice as decimal(18,2)) as price
        from lineitem join part on l_partkey = p_partkey)""",
    "cases": """cases as (
        select d.doc_id, lang, source, n_chars, quality, toxic
        from documents d join labels l on d.doc_id = l.doc_id)""",
}


def having(*names: str) -> str:
    """A WITH clause of the named domain tables."""
    return "with " + ",\n".join(CTES[n] for n in names) + "\n"


def avg2(total: str, n: str) -> str:
    """Average of an amount, rounded half up on whole cents."""
    cents = f"cast({total} * 100 as hugeint)"
    return f"case when {n} > 0 then cast((2 * {cents} + {n}) // (2 * {n}) as double) / 100 end"


def ratio(part: str, whole: str, digits: int = 2) -> str:
    """Whole-number ratio rounded half up to some digits."""
    scaled = f"(cast({part} as hugeint) * {10 ** digits})"
    return (
        f"case when {whole} > 0 then cast((2 * {scaled} + {whole}) // (2 * {whole}) as double)"
        f" / {10 ** digits} end"
    )


def stamp(column: str) -> str:
    """A timestamp as text with microseconds."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def day(column: str) -> str:
    """The date of a timestamp as text."""
    return f"strftime({column}, '%Y-%m-%d')"
