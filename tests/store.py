"""A small rental store and the sales and analytics tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

# Ratings and rates of films 1..10, film and store of copies 1..20,
# amounts of payments 1..20.
RATINGS = ["PG", "G", "NC-17", "G", "G", "PG", "PG-13", "R", "PG-13", "NC-17"]
RATES = ["0.99", "4.99", "2.99", "2.99", "2.99", "2.99", "4.99", "4.99", "2.99", "4.99"]
COPY_FILM = [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 9, 10]
COPY_STORE = [1, 1, 2, 2, 1, 2, 1, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1]
AMOUNTS = (
    "0.99 4.99 2.99 2.99 4.99 2.99 2.99 4.99 4.99 2.99 "
    "2.99 2.99 4.99 4.99 4.99 4.99 4.99 2.99 2.99 4.99"
).split()

SALES = [
    ("2025-01-01", "Laptop", "Electronics", 5, "999.99"),
    ("2025-01-01", "Mouse", "Electronics", 20, "29.99"),
    ("2025-01-01", "Desk", "Furniture", 3, "299.99"),
    ("2025-01-02", "Chair", "Furniture", 8, "149.99"),
    ("2025-01-02", "Keyboard", "Electronics", 15, "79.99"),
    ("2025-01-02", "Monitor", "Electronics", 10, "399.99"),
    ("2025-01-03", "Laptop", "Electronics", 3, "999.99"),
    ("2025-01-03", "Desk", "Furniture", 5, "299.99"),
]
COUNTRIES = ["USA", "UK", "Spain", "Japan", "Australia", "Chile"]  # customer 6 never ordered
ORDERS = [(1, "1500.00"), (1, "750.50"), (2, "2200.00"), (3, "1100.75"), (4, "890.00"),
          (5, "1650.25"), (2, "3200.00")]


def rented(i: int) -> dt.datetime:
    """Rentals 1..15 are one day apart from 1 January, 16..20 from 1 February."""
    day = dt.datetime(2024, 1, i, 10) if i <= 15 else dt.datetime(2024, 2, i - 15, 10)
    return day + dt.timedelta(hours=(i - 1) % 10 if i <= 10 else (i - 1) % 5)


def film(spark):
    rows = [
        (i + 1, f"Film {i + 1}", RATINGS[i], Decimal(RATES[i]), Decimal("20.00"), 7)
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows,
        "film_id bigint, title string, rating string, rental_rate decimal(10,2), "
        "replacement_cost decimal(10,2), rental_duration int",
    )


def inventory(spark):
    rows = [(i + 1, f, s) for i, (f, s) in enumerate(zip(COPY_FILM, COPY_STORE))]
    return spark.createDataFrame(rows, "inventory_id bigint, film_id bigint, store_id bigint")


def rental(spark):
    week = dt.timedelta(days=7, hours=4)
    rows = [(i, rented(i), i, (i - 1) % 10 + 1, rented(i) + week) for i in range(1, 21)]
    return spark.createDataFrame(
        rows,
        "rental_id bigint, rental_date timestamp, inventory_id bigint, customer_id bigint, "
        "return_date timestamp",
    )


def payment(spark):
    soon = dt.timedelta(minutes=5)
    rows = [
        (i, (i - 1) % 10 + 1, i, Decimal(AMOUNTS[i - 1]), rented(i) + soon) for i in range(1, 21)
    ]
    return spark.createDataFrame(
        rows,
        "payment_id bigint, customer_id bigint, rental_id bigint, amount decimal(18,2), "
        "payment_date timestamp",
    )


def customer(spark, n: int = 10):
    rows = [(i, f"First{i}", f"Last{i}", f"c{i}@mail.org", 1 if i <= 6 else 2, True)
            for i in range(1, n + 1)]
    return spark.createDataFrame(
        rows,
        "customer_id bigint, first_name string, last_name string, email string, "
        "store_id bigint, active boolean",
    )


def sales(spark):
    rows = [(dt.date.fromisoformat(d), p, c, q, Decimal(a)) for d, p, c, q, a in SALES]
    return spark.createDataFrame(
        rows, "date date, product string, category string, quantity int, price decimal(18,2)"
    )


def customers(spark):
    rows = [(i + 1, f"First{i}", f"Last{i}", c) for i, c in enumerate(COUNTRIES)]
    return spark.createDataFrame(
        rows, "customer_id bigint, first_name string, last_name string, country string"
    )


def orders(spark):
    rows = [(i + 1, c, dt.date(2024, 1, 10 + i), Decimal(a)) for i, (c, a) in enumerate(ORDERS)]
    return spark.createDataFrame(
        rows, "order_id bigint, customer_id bigint, order_date date, total_amount decimal(18,2)"
    )
