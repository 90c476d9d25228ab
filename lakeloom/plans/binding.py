"""The rental-store and sales domains on top of the star-schema test tables.

Orders are payments, order lines are rentals, parts are films, suppliers are
stores, staff and actors, nations and regions are cities and countries. A copy
of a film is identified by film and store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.money import money

COPY_KEY = ("film_id", "store_id")

# The columns of the test tables. A declared schema saves the
# job that would otherwise read it from a file footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def name_part(column: str, part: int) -> Column:
    """``Customer#000000012`` has two name parts."""
    return F.split(column, "#")[part]


@dataclass(frozen=True)
class Domain:
    """Lazy domain tables below one folder of Parquet files."""

    spark: SparkSession
    folder: str

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.folder}/{table}.parquet")

    def customer(self) -> DataFrame:
        email = F.concat(F.lit("  C."), name_part("c_name", 1), F.lit("@"), "c_mktsegment", F.lit(".Example.com "))
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            name_part("c_name", 0).alias("first_name"),
            name_part("c_name", 1).alias("last_name"),
            email.alias("email"),
            F.col("c_nationkey").cast("bigint").alias("store_id"),
            F.col("c_nationkey").cast("bigint").alias("address_id"),
            (F.col("c_acctbal") > 0).alias("active"),
            money("c_acctbal").alias("credit"),
        )

    def address(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("address_id"),
            F.concat(F.lit("Main street "), "n_nationkey").alias("address"),
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
            F.concat(F.lit("+"), "n_nationkey").alias("phone"),
            F.col("n_nationkey").cast("bigint").alias("city_id"),
        )

    def city(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("city_id"),
            F.col("n_name").alias("city"),
            F.col("n_regionkey").cast("bigint").alias("country_id"),
        )

    def country(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("country_id"), F.col("r_name").alias("country")
        )

    def customers(self) -> DataFrame:
        """Customers of the analytics domain; the country is the nation."""
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
        )
        return self.raw("customer").join(nation, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            name_part("c_name", 0).alias("first_name"),
            name_part("c_name", 1).alias("last_name"),
            "country",
        )

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            money("o_totalprice").alias("total_amount"),
            F.col("o_orderstatus").alias("status"),
        )

    def payment(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_orderkey").alias("rental_id"),
            F.col("o_custkey").alias("customer_id"),
            money("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("payment_date"),
        )

    def rental_line(self) -> DataFrame:
        """Rentals without the columns that need the order."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("rental_id"),
            F.col("l_linenumber").cast("bigint").alias("line_number"),
            F.col("l_partkey").alias("film_id"),
            F.col("l_suppkey").alias("store_id"),
            F.when(F.col("l_linestatus") != "O", F.col("l_quantity").cast("int")).alias("days_kept"),
        )

    def rental(self, only_open: bool = False) -> DataFrame:
        """Rentals; a line with status O is open, others were kept ``l_quantity`` days.

        ``only_open`` leaves out the returned ones before the orders are joined.
        """
        lines = self.rental_line()
        if only_open:
            lines = lines.filter(F.col("days_kept").isNull())
        dates = self.raw("orders").select(
            F.col("o_orderkey").alias("rental_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"),
        )
        returned = F.col("rental_date") + F.make_dt_interval(F.col("days_kept"))
        return lines.join(dates, "rental_id").withColumn("return_date", returned)

    def inventory(self) -> DataFrame:
        return self.rental_line().select(*COPY_KEY).distinct()

    def film(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.concat_ws(" ", "p_type", "p_brand").alias("description"),
            F.col("p_brand").alias("rating"),
            money("p_retailprice").alias("rental_rate"),
            money("p_retailprice").alias("replacement_cost"),
            F.col("p_size").alias("rental_duration"),
            F.col("p_size").alias("length"),
        )

    def film_category(self) -> DataFrame:
        """Every film is in its type's category; long films also in their brand's."""
        second = F.when(F.col("p_size") > 25, F.col("p_brand"))
        return self.raw("part").select(
            F.col("p_partkey").alias("film_id"),
            F.explode(F.array_compact(F.array("p_type", second))).alias("category"),
        )

    def actor(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("actor_id"),
            F.upper(name_part("s_name", 0)).alias("first_name"),
            name_part("s_name", 1).alias("last_name"),
        )

    def film_actor(self) -> DataFrame:
        pairs = self.raw("lineitem").select(
            F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")
        )
        return pairs.distinct()

    def store(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_suppkey").alias("manager_staff_id"),
            F.col("s_nationkey").cast("bigint").alias("address_id"),
        )

    def staff(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            F.col("s_suppkey").alias("store_id"),
            name_part("s_name", 0).alias("first_name"),
            name_part("s_name", 1).alias("last_name"),
            F.col("s_nationkey").cast("bigint").alias("address_id"),
        )

    def sales(self) -> DataFrame:
        products = self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
        )
        return self.raw("lineitem").join(products, "l_partkey").select(
            "product",
            "category",
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("price"),
        )

    def events(self) -> DataFrame:
        return self.raw("events")

    def cases(self) -> DataFrame:
        """Labelled documents as cases: outcome ``quality``, condition ``toxic``."""
        labels = self.raw("labels").select("doc_id", "quality", "toxic")
        documents = self.raw("documents").select("doc_id", "lang", "source", "n_chars")
        return documents.join(labels, "doc_id")
