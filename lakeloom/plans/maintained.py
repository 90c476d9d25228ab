"""Business tables kept up to date by batches of changes instead of computed anew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.money import average
from lakeloom.operators.ranking import global_rank
from lakeloom.operators.views import Changing, ExtremesView, GroupedView
from lakeloom.plans.marts import CUSTOMER_COLUMNS, period


@dataclass(frozen=True)
class MonthlyRevenue:
    """Revenue by month and film rating; a batch writes the months that it touches."""

    spark: SparkSession
    root: str

    @property
    def view(self) -> GroupedView:
        return GroupedView(
            self.spark, self.root, ("year", "month", "rating"),
            {"total_revenue": "amount"}, {"_n": "amount"}, ("year", "month"),
        )

    def apply(self, payment: Changing, rental: Changing, film: Changing, batch: int) -> list[tuple]:
        """Apply one batch of changes of any of the tables; returns the months written."""
        paid = payment.select("rental_id", "amount", *period("payment_date"))
        fact = paid.join(rental.select("rental_id", "film_id"), "rental_id")
        rated = fact.join(film.select("film_id", "rating"), "film_id")
        return [] if rated.change is None else self.view.apply(rated.change, batch)

    def read(self) -> DataFrame:
        mean = average(F.col("total_revenue"), F.col("_n")).alias("avg_transaction")
        rows = self.view.read().withColumnRenamed("_rows", "transaction_count")
        return rows.select("year", "month", "rating", "total_revenue", "transaction_count", mean)


@dataclass(frozen=True)
class CustomerValue:
    """Spending, rentals and first and last payment per customer.

    Ranks depend on all customers, so they are computed from the kept totals when read.
    """

    spark: SparkSession
    root: str

    @property
    def spent(self) -> GroupedView:
        return GroupedView(
            self.spark, f"{self.root}/spent", ("customer_id",), {"total_spent": "amount"}, {"_n": "amount"}
        )

    @property
    def rented(self) -> GroupedView:
        return GroupedView(self.spark, f"{self.root}/rented", ("customer_id",), {}, {})

    @property
    def dates(self) -> ExtremesView:
        return ExtremesView.of(self.spark, f"{self.root}/dates", "customer_id", "payment_date")

    def apply(self, payment: Changing, rental: Changing, batch: int) -> None:
        if payment.change is not None:
            self.spent.apply(payment.change, batch)
            self.dates.apply(payment.change, batch)
        if rental.change is not None:
            self.rented.apply(rental.change, batch)

    def read(self, customer: DataFrame) -> DataFrame:
        spent = self.spent.read().withColumnRenamed("_rows", "total_transactions").withColumn(
            "avg_transaction_value", average(F.col("total_spent"), F.col("_n"))
        )
        rented = self.rented.read().withColumnRenamed("_rows", "total_rentals")
        dates = self.dates.read("first_payment_date", "last_payment_date")
        metrics = customer.select(*CUSTOMER_COLUMNS)
        for part in (spent.drop("_n"), rented, dates):
            metrics = metrics.join(part, "customer_id", "left")
        return global_rank(metrics, "total_spent", dense="clv_rank", percentile="clv_percentile")
