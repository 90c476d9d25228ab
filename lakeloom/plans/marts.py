"""Business tables over the rental-store and sales domains.

Inputs are lazy tables with the domain's column names. ``rental`` always
carries ``film_id`` and ``store_id`` of the rented copy; ``rental_items`` adds
them where a copy is identified by ``inventory_id``.

Several payments may point at one rental. They are summed per rental before
the join, so a join never multiplies rows on both sides, while counts are kept
as if every payment were joined to its rental.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.money import average
from lakeloom.operators.ranking import global_rank


def rental_items(rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rentals with the film and store of the rented copy."""
    return rental.join(inventory.select("inventory_id", "film_id", "store_id"), "inventory_id")


def payments_per_rental(payment: DataFrame, unique: bool, *more: Column) -> DataFrame:
    """Payment totals per rental (and further groups).

    With ``unique`` the caller vouches that no rental has two payments (the
    key check in ``quality`` tells), and no aggregate or shuffle is needed.
    """
    if unique:
        one = F.lit(1).cast("bigint")
        return payment.select(
            "rental_id",
            *more,
            F.col("amount").alias("paid"),
            one.alias("n_payments"),
            F.when(F.col("amount").isNotNull(), one).otherwise(F.lit(0)).alias("n_amounts"),
        )
    return payment.groupBy("rental_id", *more).agg(
        F.sum("amount").alias("paid"),
        F.count("*").alias("n_payments"),
        F.count("amount").alias("n_amounts"),
    )


def period(column: str) -> list[Column]:
    """Year and month of a timestamp as grouping columns."""
    return [F.year(column).alias("year"), F.month(column).alias("month")]


def sales_fact(payment: DataFrame, rental: DataFrame, unique: bool = False) -> DataFrame:
    """Payments by rental, month, film and store: the wide table other marts reuse."""
    paid = payments_per_rental(payment, unique, *period("payment_date"))
    return rental.select("rental_id", "film_id", "store_id").join(paid, "rental_id")


def _revenue(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    totals = fact.groupBy(*keys).agg(
        F.sum("paid").alias("total_revenue"),
        F.sum("n_payments").alias("transaction_count"),
        F.sum("n_amounts").alias("_n"),
    )
    mean = average(F.col("total_revenue"), F.col("_n")).alias("avg_transaction")
    return totals.select(*keys, "total_revenue", "transaction_count", mean).orderBy(*keys)


def _per_film(fact: DataFrame) -> DataFrame:
    """Films summed per month, so that a join with several rows a film multiplies totals only."""
    return fact.groupBy("film_id", "year", "month").agg(
        *[F.sum(c).alias(c) for c in ("paid", "n_payments", "n_amounts")]
    )


def monthly_revenue(payment: DataFrame, rental: DataFrame, film: DataFrame,
                    unique: bool = False) -> DataFrame:
    """Revenue, payments and average payment by month and film rating.

    A film has one rating, so the join multiplies nothing and the payments meet it as they
    are; the sums by month and rating, few as they are, are then the only other shuffle.
    """
    fact = sales_fact(payment, rental, unique)
    return _revenue(fact.join(film.select("film_id", "rating"), "film_id"), ["year", "month", "rating"])


def monthly_revenue_by_category(
    payment: DataFrame, rental: DataFrame, film_category: DataFrame, unique: bool = False
) -> DataFrame:
    """The same by film category; a film in two categories counts in both."""
    per_film = _per_film(sales_fact(payment, rental, unique))
    return _revenue(
        per_film.join(film_category.select("film_id", "category"), "film_id"),
        ["year", "month", "category"],
    )


def customer_metrics(customer: DataFrame, payment: DataFrame, rental: DataFrame,
                     keep: Sequence[str]) -> DataFrame:
    """Spending and rentals per customer; customers without any keep NULLs."""
    spent = payment.groupBy("customer_id").agg(
        F.sum("amount").alias("total_spent"),
        F.count("*").alias("total_transactions"),
        average(F.sum("amount"), F.count("amount")).alias("avg_transaction_value"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    )
    rented = rental.groupBy("customer_id").agg(F.count("*").alias("total_rentals"))
    return customer.join(spent, "customer_id", "left").join(rented, "customer_id", "left").select(
        *keep,
        "total_spent",
        "total_transactions",
        "total_rentals",
        "avg_transaction_value",
        "first_payment_date",
        "last_payment_date",
    )


CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email")


def customer_lifetime_value(customer: DataFrame, payment: DataFrame, rental: DataFrame,
                            keep: Sequence[str] = CUSTOMER_COLUMNS) -> DataFrame:
    """Customer metrics with their rank and percentile by total spending."""
    metrics = customer_metrics(customer, payment, rental, keep)
    return global_rank(metrics, "total_spent", dense="clv_rank", percentile="clv_percentile")


def _rentals_with_payments(rental: DataFrame, payment: DataFrame, unique: bool) -> DataFrame:
    """Rentals with their payment totals; an unpaid rental counts as one row."""
    paid = payments_per_rental(payment, unique)
    joined = rental.join(paid, "rental_id", "left")
    return joined.withColumn("_rows", F.coalesce("n_payments", F.lit(1)))


def _rental_totals(joined: DataFrame, keys: Sequence[str | Column], mean_name: str) -> DataFrame:
    totals = joined.groupBy(*keys).agg(
        F.sum("_rows").alias("total_rentals"),
        F.sum("paid").alias("total_revenue"),
        F.sum("n_amounts").alias("_n"),
    )
    mean = average(F.col("total_revenue"), F.coalesce("_n", F.lit(0)))
    return totals.withColumn(mean_name, mean).drop("_n")


FILM_COLUMNS = ("title", "rating", "rental_rate", "replacement_cost")


def film_performance(rental: DataFrame, film: DataFrame, payment: DataFrame,
                     unique: bool = False) -> DataFrame:
    """Rentals and revenue per rented film, with a popularity rank."""
    joined = _rentals_with_payments(rental.select("rental_id", "film_id"), payment, unique)
    totals = _rental_totals(joined, ["film_id"], "avg_revenue_per_rental")
    films = totals.join(film.select("film_id", *FILM_COLUMNS), "film_id")
    ranked = global_rank(
        films.select("film_id", *FILM_COLUMNS, "total_rentals", "total_revenue",
                     "avg_revenue_per_rental"),
        "total_rentals",
        dense="popularity_rank",
    )
    return ranked.orderBy("popularity_rank", "film_id")


def store_performance(rental: DataFrame, payment: DataFrame, unique: bool = False) -> DataFrame:
    """Rentals and revenue per store and month of rental."""
    joined = _rentals_with_payments(
        rental.select("rental_id", "store_id", "rental_date"), payment, unique
    )
    totals = _rental_totals(joined, ["store_id", *period("rental_date")], "avg_transaction")
    return totals.orderBy("store_id", "year", "month")


def _line_revenue(sales: DataFrame) -> DataFrame:
    return sales.withColumn("revenue", (F.col("quantity") * F.col("price")).cast("decimal(28,2)"))


def product_sales(sales: DataFrame) -> DataFrame:
    """Units and revenue per product, best first."""
    return (
        _line_revenue(sales)
        .groupBy("product")
        .agg(F.sum("quantity").alias("total_quantity"), F.sum("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "product")
    )


def category_sales(sales: DataFrame) -> DataFrame:
    """Transactions, items, revenue and average per category, best first."""
    return (
        _line_revenue(sales)
        .groupBy("category")
        .agg(
            F.count("*").alias("transactions"),
            F.sum("quantity").alias("total_items"),
            F.sum("revenue").alias("total_revenue"),
            average(F.sum("revenue"), F.count("revenue")).alias("avg_transaction_value"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def customer_order_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, total and average per customer; customers without orders stay."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("_n"),
        F.sum("total_amount").alias("total_spent"),
        average(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"),
    )
    return (
        customers.join(per_customer, "customer_id", "left")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "country",
            F.coalesce("_n", F.lit(0)).alias("total_orders"),
            "total_spent",
            "avg_order_value",
        )
        .orderBy(F.desc_nulls_last("total_spent"), "customer_id")
    )


def sales_by_country(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders and total per country, best first."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("_n"), F.sum("total_amount").alias("_total")
    )
    return (
        customers.select("customer_id", "country")
        .join(per_customer, "customer_id")
        .groupBy("country")
        .agg(F.sum("_n").alias("total_orders"), F.sum("_total").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), "country")
    )


def revenue_by_country_month(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders and revenue per country and month."""
    monthly = orders.groupBy("customer_id", F.trunc("order_date", "month").alias("month")).agg(
        F.count("*").alias("_n"), F.sum("total_amount").alias("_total")
    )
    return (
        monthly.join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country", "month")
        .agg(F.sum("_n").alias("customer_count"), F.sum("_total").alias("revenue"))
    )


def word_count(lines: DataFrame, words: Column) -> DataFrame:
    """Occurrences of each word, most frequent first."""
    counted = lines.select(F.explode(words).alias("word")).groupBy("word").count()
    return counted.orderBy(F.desc("count"), "word")


def bucket_aggregate(df: DataFrame, key: str, value: str, buckets: int = 100) -> DataFrame:
    """Rows and average per bucket (key modulo the number of buckets)."""
    numbered = df.groupBy((F.col(key) % buckets).alias("bucket"))
    return numbered.agg({value: "avg", key: "count"})


def active_customers(customer: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Selected columns of the active customers."""
    return customer.filter("active").select(*columns)


def customers_per_store(customer: DataFrame) -> DataFrame:
    """Active customers per store."""
    return customer.filter("active").groupBy("store_id").count()
