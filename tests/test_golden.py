"""Results worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.text import capitalise, words
from lakeloom.operators.relational import ordered_list, search
from lakeloom.plans import marts, reports
from tests import store


def rows(df, *columns):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def items(spark):
    return marts.rental_items(store.rental(spark), store.inventory(spark))


@pytest.mark.parametrize("unique", [True, False])
def test_monthly_revenue(spark, items, unique):
    found = marts.monthly_revenue(store.payment(spark), items, store.film(spark), unique)
    assert rows(found, "year", "month", "rating", "total_revenue", "transaction_count", "avg_transaction") == [
        (2024, 1, "G", "23.94", 6, "3.99"),
        (2024, 1, "NC-17", "5.98", 2, "2.99"),
        (2024, 1, "PG", "16.95", 5, "3.39"),
        (2024, 1, "PG-13", "9.98", 2, "4.99"),
        (2024, 2, "NC-17", "4.99", 1, "4.99"),
        (2024, 2, "PG-13", "5.98", 2, "2.99"),
        (2024, 2, "R", "9.98", 2, "4.99"),
    ]


def test_customer_lifetime_value(spark, items):
    found = marts.customer_lifetime_value(
        store.customer(spark), store.payment(spark), store.rental(spark)
    )
    got = {r[0]: r[1:] for r in rows(found, "customer_id", "total_spent", "clv_rank", "clv_percentile")}
    assert got[5] == ("9.98", 1, "0.00")
    assert got[1] == ("3.98", 3, "100.00")
    assert all(got[i] == ("7.98", 2, "11.11") for i in (2, 3, 4, 6, 7, 8, 9, 10))


def test_customer_without_payments_ranks_last(spark, items):
    found = marts.customer_lifetime_value(
        store.customer(spark, 11), store.payment(spark), store.rental(spark)
    )
    last = found.filter("customer_id = 11").first()
    assert (last.total_spent, last.total_rentals, last.clv_rank, last.clv_percentile) == (
        None, None, 4, Decimal("100.00"))


@pytest.mark.parametrize("unique", [True, False])
def test_film_performance(spark, items, unique):
    found = marts.film_performance(items, store.film(spark), store.payment(spark), unique)
    got = rows(found, "film_id", "total_rentals", "total_revenue", "popularity_rank")
    assert got[0] == (1, 3, "8.97", 1)
    assert got[-1] == (10, 1, "4.99", 3)
    assert {(r[0], r[2]) for r in got if r[3] == 2} == {
        (2, "7.98"), (3, "5.98"), (4, "9.98"), (5, "5.98"), (6, "7.98"), (7, "9.98"), (8, "9.98"), (9, "5.98")}


def test_two_payments_of_one_rental_count_twice(spark, items):
    payment = store.payment(spark)
    again = payment.filter("rental_id = 20").withColumn("payment_id", F.lit(99).cast("bigint"))
    found = marts.film_performance(items, store.film(spark), payment.unionByName(again))
    film = found.filter("film_id = 10").first()
    assert (film.total_rentals, film.total_revenue) == (2, Decimal("9.98"))


def test_unpaid_rental_still_counts(spark, items):
    found = marts.store_performance(items, store.payment(spark).filter("rental_id <> 20"))
    row = found.filter("store_id = 1 and month = 2").first()
    assert (row.total_rentals, row.total_revenue) == (3, Decimal("7.98"))


def test_store_performance(spark, items):
    found = marts.store_performance(items, store.payment(spark))
    assert rows(found, "store_id", "year", "month", "total_rentals", "total_revenue", "avg_transaction") == [
        (1, 2024, 1, 8, "29.92", "3.74"),
        (1, 2024, 2, 3, "12.97", "4.32"),
        (2, 2024, 1, 7, "26.93", "3.85"),
        (2, 2024, 2, 2, "7.98", "3.99"),
    ]


def test_product_and_category_sales(spark):
    sales = store.sales(spark)
    assert rows(marts.product_sales(sales), "product", "total_quantity", "total_revenue") == [
        ("Laptop", 8, "7999.92"),
        ("Monitor", 10, "3999.90"),
        ("Desk", 8, "2399.92"),
        ("Chair", 8, "1199.92"),
        ("Keyboard", 15, "1199.85"),
        ("Mouse", 20, "599.80"),
    ]
    columns = ("category", "transactions", "total_items", "total_revenue", "avg_transaction_value")
    assert rows(marts.category_sales(sales), *columns) == [
        ("Electronics", 5, 53, "13799.47", "2759.89"),
        ("Furniture", 3, 16, "3599.84", "1199.95"),
    ]


def test_customer_orders(spark):
    customers, orders = store.customers(spark), store.orders(spark)
    summary = marts.customer_order_summary(customers, orders)
    assert rows(summary, "customer_id", "total_orders", "total_spent", "avg_order_value") == [
        (2, 2, "5400.00", "2700.00"),
        (1, 2, "2250.50", "1125.25"),
        (5, 1, "1650.25", "1650.25"),
        (3, 1, "1100.75", "1100.75"),
        (4, 1, "890.00", "890.00"),
        (6, 0, None, None),
    ]
    assert rows(marts.sales_by_country(customers, orders), "country", "total_revenue") == [
        ("UK", "5400.00"), ("USA", "2250.50"), ("Australia", "1650.25"), ("Spain", "1100.75"), ("Japan", "890.00")]


def test_word_count(spark):
    lines = spark.createDataFrame([("to be or not to be,",), ("a  b",), ("",), (None,)], "text string")
    got = {r["word"]: r["count"] for r in marts.word_count(lines, words(F.col("text"))).collect()}
    assert got == {"to": 2, "be": 1, "be,": 1, "or": 1, "not": 1, "a": 1, "b": 1, "": 2}


def test_customers_per_store(spark):
    got = {r["store_id"]: r["count"] for r in marts.customers_per_store(store.customer(spark)).collect()}
    assert got == {1: 6, 2: 4}


def test_rewards_needs_both_limits_strictly(spark):
    customer, payment = store.customer(spark), store.payment(spark)

    def keys(n, amount):
        found = reports.rewards(customer, payment, "2024-02-20", n, amount)
        return sorted(r.customer_id for r in found.collect())

    assert keys(1, "7.97") == [2, 3, 4, 5]
    assert keys(1, "7.98") == [5]
    assert keys(2, "0.01") == []
    with pytest.raises(ValueError):
        reports.rewards(customer, payment, "2024-02-20", 0, 1)
    with pytest.raises(ValueError):
        reports.rewards(customer, payment, "2024-02-20", 1, 0)


def test_balance(spark, items):
    # Allowed 7 days, kept 7: nothing overdue. Customer 11 never rented.
    found = reports.balances(store.customer(spark, 11), items, store.film(spark), store.payment(spark),
                             "2024-01-31 00:00:00")
    got = {r.customer_id: (str(r.rent_fees), r.overdue_days, str(r.payments), str(r.balance))
           for r in found.collect()}
    assert got[1] == ("3.98", 0, "3.98", "0.00")
    assert got[10] == ("2.99", 0, "2.99", "0.00")
    assert got[11] == ("0.00", 0, "0.00", "0.00")
    late = items.withColumn("return_date", F.col("rental_date") + F.expr("interval 9 days"))
    found = reports.balances(store.customer(spark), late, store.film(spark), store.payment(spark),
                             "2024-01-31 00:00:00")
    assert found.filter("customer_id = 1").first().overdue_days == 4


def test_stock(spark, items):
    copies = store.inventory(spark)
    out = items.withColumn("return_date", F.when(F.col("rental_id") != 4, F.col("return_date")))
    key = ["inventory_id"]
    assert [r.inventory_id for r in reports.items_out(copies, out, key).collect()] == [4]
    assert reports.items_in_stock(copies, out, key).count() == 19
    holder = reports.item_holder(copies, out, key, ["rental_date", "rental_id"])
    assert {r.inventory_id: r.customer_id for r in holder.collect()}[4] == 4
    assert holder.filter("customer_id is null").count() == 19
    never = spark.createDataFrame([(77, 1, 1)], copies.schema)
    flags = reports.stock_flags(copies.unionByName(never), out, key)
    got = {r.inventory_id: r.in_stock for r in flags.collect()}
    assert got[77] is True and got[4] is False


def test_film_list_keeps_films_without_actors_or_categories(spark):
    film = store.film(spark).filter("film_id <= 3").withColumns(
        {"description": F.lit(None).cast("string"), "length": F.lit(1)})
    category = spark.createDataFrame([(1, "Drama"), (1, "Music"), (2, "Drama")], "film_id bigint, category string")
    actor = spark.createDataFrame(
        [(1, "ann", "MC lee"), (2, "BOB", "ray"), (3, "CY", "no")],
        "actor_id bigint, first_name string, last_name string")
    cast = spark.createDataFrame([(1, 1), (1, 2), (3, 2)], "film_id bigint, actor_id bigint")
    found = reports.film_list(film, category, cast, actor, formatted=True)
    got = {(r.FID, r.category): r.actors for r in found.collect()}
    assert got == {(1, "Drama"): "Ann Mc lee, Bob Ray", (1, "Music"): "Ann Mc lee, Bob Ray",
                   (2, "Drama"): None, (3, None): "Bob Ray"}
    info = reports.actor_info(actor, cast, category, film)
    got = {r.actor_id: r.film_info for r in info.collect()}
    assert got == {1: "Drama: Film 1; Music: Film 1", 2: "Drama: Film 1; Music: Film 1", 3: None}


def test_ordered_list_equals_sorted(spark):
    values = [f"{(i * 7919) % 1000:04d}" for i in range(500)] + ["é", "Z", "a", "a"]
    rows_ = [(i % 3, v) for i, v in enumerate(values)] + [(9, None)]
    df = spark.createDataFrame(rows_, "k int, v string")
    got = {r.k: r.v for r in ordered_list(df, ["k"], "v", "|").collect()}
    for k in range(3):
        want = sorted((v for j, v in rows_ if j == k), key=lambda v: v.encode())
        assert got[k] == "|".join(want)
    assert 9 not in got
    distinct = {r.k: r.v for r in ordered_list(df, ["k"], "v", "|", distinct=True).collect()}
    assert distinct[0] == "|".join(sorted({v for j, v in rows_ if j == 0}, key=lambda v: v.encode()))


def test_search_needs_every_term(spark):
    df = spark.createDataFrame([(1, "Red fox", "jumps"), (2, "red", None), (3, "a FOX, red!", "x")],
                               "id int, title string, body string")
    assert sorted(r.id for r in search(df, "id", ["title", "body"], ["fox", "RED"]).collect()) == [1, 3]


def test_capitalise(spark):
    df = spark.createDataFrame([("mcDONALD smith",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(capitalise(F.col("v"))).collect()] == ["Mcdonald smith", "", None]


def test_overdue_uses_calendar_days(spark):
    from lakeloom.functions.dates import days_between

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 3, 1))], "a timestamp, b timestamp")
    assert df.select(days_between(F.col("b"), F.col("a"))).first()[0] == 2
