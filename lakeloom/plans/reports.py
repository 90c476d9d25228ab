"""Lists, per-key routines and stock reports of the rental store.

The per-key routines of a database (balance of one customer, stock of one
film) are built for all keys at once; filter the result for a single key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import days_between, previous_month
from lakeloom.functions.text import capitalise
from lakeloom.operators.ranking import latest_by_key
from lakeloom.operators.asof import totals_as_of
from lakeloom.operators.relational import keep_matching, keep_missing, ordered_list
from lakeloom.plans.marts import payments_per_rental


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name with a blank; NULL if either is."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def located(df: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Add city and country names to rows with a ``city_id``."""
    cities = city.select("city_id", "city", "country_id")
    countries = country.select("country_id", "country")
    return df.join(cities, "city_id").join(countries, "country_id")


def _address_list(people: DataFrame, key: str, places: DataFrame, *more: Column) -> DataFrame:
    """People with their address, city and country."""
    return people.join(places, "address_id").select(
        F.col(key).alias("ID"),
        full_name().alias("name"),
        "address",
        F.col("postal_code").alias("zip code"),
        "phone",
        "city",
        "country",
        *more,
        F.col("store_id").alias("SID"),
    )


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame,
                  country: DataFrame) -> DataFrame:
    """Customers with address, city and country; notes say whether they are active."""
    notes = F.when(F.col("active"), "active").otherwise("").alias("notes")
    return _address_list(customer, "customer_id", located(address, city, country), notes)


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Staff with address, city and country."""
    return _address_list(staff, "staff_id", located(address, city, country))


def film_list(film: DataFrame, film_category: DataFrame, film_actor: DataFrame, actor: DataFrame,
              formatted: bool = False) -> DataFrame:
    """One row per film and category with its actors as ordered text.

    Actors are listed once per film; a film without actors or categories
    stays. ``formatted`` capitalises each name field.
    """
    first, last = F.col("first_name"), F.col("last_name")
    if formatted:
        first, last = capitalise(first), capitalise(last)
    names = actor.select("actor_id", F.concat(first, F.lit(" "), last).alias("_name"))
    cast = film_actor.select("film_id", "actor_id").join(names, "actor_id")
    actors = ordered_list(cast, ["film_id"], "_name", name="actors")
    bridge = film_category.select("film_id", "category")
    return (
        film.join(bridge, "film_id", "left")
        .join(actors, "film_id", "left")
        .select(
            F.col("film_id").alias("FID"),
            "title",
            "description",
            "category",
            F.col("rental_rate").alias("price"),
            "length",
            "rating",
            "actors",
        )
    )


def actor_info(actor: DataFrame, film_actor: DataFrame, film_category: DataFrame,
               film: DataFrame) -> DataFrame:
    """Per actor the films by category as one text; actors without films get NULL."""
    titles = film.select("film_id", "title").join(film_category.select("film_id", "category"), "film_id")
    played = film_actor.select("film_id", "actor_id").join(titles, "film_id")
    # One shuffle by actor: each of the sorted pairs is written behind the one before.
    pairs = F.array_sort(F.collect_list(F.struct("category", "title")))
    listed = played.dropna(subset=["category", "title"]).groupBy("actor_id").agg(pairs.alias("_pairs"))

    def written(pair, i):
        named = F.concat(pair["category"], F.lit(": "), pair["title"])
        same = F.get("_pairs", i - 1)["category"] == pair["category"]
        return F.when(i == 0, named).when(same, F.concat(F.lit(", "), pair["title"])).otherwise(
            F.concat(F.lit("; "), named)
        )

    info = listed.select("actor_id", F.array_join(F.transform("_pairs", written), "").alias("film_info"))
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def sales_by_store(payment: DataFrame, rental: DataFrame, store: DataFrame, staff: DataFrame,
                   address: DataFrame, city: DataFrame, country: DataFrame,
                   unique: bool = False) -> DataFrame:
    """Total sales per store with its place and manager, by country and city.

    Sales are summed per store before the descriptive tables are joined.
    """
    paid = payments_per_rental(payment, unique)
    sold = (
        rental.select("rental_id", "store_id")
        .join(paid, "rental_id")
        .groupBy("store_id")
        .agg(F.sum("paid").alias("total_sales"))
    )
    managers = staff.select(F.col("staff_id").alias("manager_staff_id"), full_name().alias("manager"))
    stores = store.select("store_id", "manager_staff_id", "address_id")
    return (
        located(sold.join(stores, "store_id").join(address.select("address_id", "city_id"), "address_id"),
                city, country)
        .join(managers, "manager_staff_id")
        .orderBy("country", "city", "store_id")
        .select(
            F.concat(F.col("city"), F.lit(","), F.col("country")).alias("store"),
            "manager",
            "total_sales",
        )
    )


def sales_by_film_category(payment: DataFrame, rental: DataFrame, film_category: DataFrame,
                           unique: bool = False) -> DataFrame:
    """Total sales per category, best first; a film counts in each of its categories."""
    paid = payments_per_rental(payment, unique)
    per_film = (
        rental.select("rental_id", "film_id")
        .join(paid, "rental_id")
        .groupBy("film_id")
        .agg(F.sum("paid").alias("paid"))
    )
    return (
        per_film.join(film_category.select("film_id", "category"), "film_id")
        .groupBy("category")
        .agg(F.sum("paid").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "category")
    )


def rewards(customer: DataFrame, payment: DataFrame, as_of: str, min_purchases: int,
            min_amount: float | str) -> DataFrame:
    """Customers above both limits in the calendar month before ``as_of``."""
    if min_purchases <= 0:
        raise ValueError("minimum monthly purchases must be > 0")
    if float(min_amount) <= 0:
        raise ValueError("minimum monthly amount must be > 0")
    first, last = previous_month(F.lit(as_of).cast("date"))
    good = (
        payment.filter(F.col("payment_date") >= first)
        .filter(F.col("payment_date") < F.date_add(last, 1))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_sum"), F.count("customer_id").alias("_n"))
        .filter((F.col("_sum") > F.lit(str(min_amount)).cast("decimal(18,2)")) & (F.col("_n") > min_purchases))
    )
    return keep_matching(customer, good, ["customer_id"])


def balances(customer: DataFrame, rental: DataFrame, film: DataFrame, payment: DataFrame,
             as_of: str) -> DataFrame:
    """Balance per customer up to a time: fees plus overdue days minus payments.

    Each day beyond the allowed ones costs one; open rentals add none.
    """
    until = F.lit(as_of)  # takes the column's own type, so the filter reaches the scan
    kept = days_between(F.col("return_date"), F.col("rental_date"))
    over = F.greatest(kept - F.col("rental_duration"), F.lit(0))
    late = F.when(F.col("return_date").isNotNull(), over).otherwise(0)
    owed = (
        rental.filter(F.col("rental_date") <= until)
        .select("customer_id", "film_id", "rental_date", "return_date")
        .join(film.select("film_id", "rental_rate", "rental_duration"), "film_id")
        .groupBy("customer_id")
        .agg(F.sum("rental_rate").alias("_fees"), F.sum(late).alias("_late"))
    )
    paid = (
        payment.filter(F.col("payment_date") <= until)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_paid"))
    )
    zero = F.lit(0)
    fees = F.coalesce("_fees", zero).cast("decimal(28,2)").alias("rent_fees")
    overdue = F.coalesce("_late", zero).cast("bigint").alias("overdue_days")
    payments = F.coalesce("_paid", zero).cast("decimal(28,2)").alias("payments")
    return (
        customer.select("customer_id")
        .join(owed, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select("customer_id", fees, overdue, payments)
        .withColumn("balance", F.col("rent_fees") + F.col("overdue_days") - F.col("payments"))
    )


def balances_at(asked: DataFrame, rental: DataFrame, film: DataFrame, payment: DataFrame) -> DataFrame:
    """The same balance for many (``customer_id``, ``at``) pairs in one sweep.

    One row for each different pair; pairs without rentals and payments have zeros.
    """
    kept = days_between(F.col("return_date"), F.col("rental_date"))
    over = F.greatest(kept - F.col("rental_duration"), F.lit(0))
    late = F.when(F.col("return_date").isNotNull(), over).otherwise(0).cast("bigint")
    none = F.lit(0).cast("bigint").alias("overdue_days")
    nothing = F.lit(0).cast("decimal(18,2)")
    owed = rental.select("customer_id", "film_id", "rental_date", "return_date").join(
        film.select("film_id", "rental_rate", "rental_duration"), "film_id"
    ).select(
        "customer_id", F.col("rental_date").alias("at"), F.col("rental_rate").alias("rent_fees"),
        late.alias("overdue_days"), nothing.alias("payments"),
    )
    paid = payment.select(
        "customer_id", F.col("payment_date").alias("at"), nothing.alias("rent_fees"), none,
        F.col("amount").alias("payments"),
    )
    measures = ["rent_fees", "overdue_days", "payments"]
    totals = totals_as_of(owed.unionByName(paid), asked, "customer_id", "at", measures)
    balance = (F.col("rent_fees") + F.col("overdue_days") - F.col("payments")).cast("decimal(38,2)")
    return totals.withColumn("balance", balance)


def open_rentals(rental: DataFrame) -> DataFrame:
    """Rentals that were not returned."""
    return rental.filter(F.col("return_date").isNull())


def items_in_stock(inventory: DataFrame, rental: DataFrame, copy_key: Sequence[str]) -> DataFrame:
    """Copies without an open rental (never rented copies included)."""
    return keep_missing(inventory, open_rentals(rental), copy_key)


def items_out(inventory: DataFrame, rental: DataFrame, copy_key: Sequence[str]) -> DataFrame:
    """Copies with an open rental."""
    return keep_matching(inventory, open_rentals(rental), copy_key)


def film_stock(items: DataFrame, film_id: int, store_id: int) -> DataFrame:
    """The copies of one film in one store, from a list of copies."""
    return items.filter((F.col("film_id") == film_id) & (F.col("store_id") == store_id))


def item_holder(inventory: DataFrame, rental: DataFrame, copy_key: Sequence[str],
                newest: Sequence[str]) -> DataFrame:
    """Every copy with the customer who holds it, NULL if in stock.

    Should a copy have several open rentals, the newest one counts.
    """
    wanted = [*copy_key, *newest, "customer_id"]
    held = latest_by_key(
        open_rentals(rental).select(*dict.fromkeys(wanted)), list(copy_key), list(newest)
    )
    return inventory.join(held.select(*copy_key, "customer_id"), list(copy_key), "left")


def stock_flags(inventory: DataFrame, rental: DataFrame, copy_key: Sequence[str]) -> DataFrame:
    """Every copy with a flag whether it is in stock."""
    out = open_rentals(rental).select(*copy_key).distinct().withColumn("_out", F.lit(True))
    flagged = inventory.join(out, list(copy_key), "left")
    return flagged.withColumn("in_stock", F.col("_out").isNull()).drop("_out")
