"""Schema contracts. Money is decimal; keys are wide integers."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the supported domains.
RENTAL_STORE = {
    "category": "category_id bigint, name string, last_update timestamp",
    "language": "language_id bigint, name string, last_update timestamp",
    "film": (
        "film_id bigint, title string, description string, release_year int, "
        "language_id bigint, rental_duration int, rental_rate decimal(10,2), length int, "
        "replacement_cost decimal(10,2), rating string, last_update timestamp"
    ),
    "film_category": "film_id bigint, category_id bigint, last_update timestamp",
    "film_actor": "actor_id bigint, film_id bigint, last_update timestamp",
    "actor": "actor_id bigint, first_name string, last_name string, last_update timestamp",
    "address": (
        "address_id bigint, address string, address2 string, district string, city_id bigint, "
        "postal_code string, phone string, last_update timestamp"
    ),
    "city": "city_id bigint, city string, country_id bigint, last_update timestamp",
    "country": "country_id bigint, country string, last_update timestamp",
    "store": "store_id bigint, manager_staff_id bigint, address_id bigint, last_update timestamp",
    "staff": (
        "staff_id bigint, first_name string, last_name string, address_id bigint, email string, "
        "store_id bigint, active boolean, username string, last_update timestamp"
    ),
    "customer": (
        "customer_id bigint, store_id bigint, first_name string, last_name string, email string, "
        "address_id bigint, active boolean, create_date date, last_update timestamp"
    ),
    "inventory": "inventory_id bigint, film_id bigint, store_id bigint, last_update timestamp",
    "rental": (
        "rental_id bigint, rental_date timestamp, inventory_id bigint, customer_id bigint, "
        "return_date timestamp, staff_id bigint, last_update timestamp"
    ),
    "payment": (
        "payment_id bigint, customer_id bigint, staff_id bigint, rental_id bigint, "
        "amount decimal(18,2), payment_date timestamp, last_update timestamp"
    ),
}

ANALYTICS = {
    "customers": (
        "customer_id bigint, first_name string, last_name string, email string, city string, "
        "country string, created_at timestamp"
    ),
    "orders": (
        "order_id bigint, customer_id bigint, order_date date, total_amount decimal(18,2), "
        "status string"
    ),
}

SALES = "date date, product string, category string, quantity int, price decimal(18,2)"

MEDICAL = (
    "age int, sex int, angina int, systolic int, cholesterol int, diabetes int, "
    "electrocardiogram int, max_heart_rate int, exercise_induced_angina int, "
    "ST_depression double, ST_slope int, number_of_major_vessels int, thalassemia int, "
    "heart_disease int"
)

CHANGE_RECORD = "topic string, key string, value string, ts timestamp"

RATINGS = ["G", "PG", "PG-13", "R", "NC-17"]


def struct(ddl: str) -> T.StructType:
    """A struct type from a column list."""
    return T.StructType.fromDDL(ddl)
