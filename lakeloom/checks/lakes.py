"""The layered lake: writes, refreshes, the batch jobs and layouts."""

import datetime as dt
from dataclasses import replace

import lakeloom.checks.marts  # noqa: F401  (its queries are looked up below)
from lakeloom.checks.registry import REGISTRY, avg2, check, day, having, stamp
from lakeloom.operators import curve
from lakeloom.operators.layout import layout_report
from lakeloom.operators.quality import default_rules
from lakeloom.plans import marts, medallion
from lakeloom.plans.binding import COPY_KEY
from lakeloom.session import materialize, scratch_path
from lakeloom.sources.lake import Lake, without_stamps
from lakeloom.sources.relational import FrameSource
from pyspark.sql import functions as F


def _lake(d) -> Lake:
    return Lake(d.spark, scratch_path(d.spark, "lake"))


PAYMENT_SCHEMA = (
    "payment_id bigint, rental_id bigint, customer_id bigint, amount decimal(18,2), payment_date timestamp_ntz"
)
PAYMENT_SQL = having("payment") + f"""select payment_id, rental_id, customer_id,
    cast(amount as double) as amount, {stamp('payment_date')} as payment_date from payment"""


@check("snk_03_bronze_overwrite", PAYMENT_SQL)
def snk_03_bronze_overwrite(d):
    lake = _lake(d)
    lake.write_bronze(d.payment(), "payment")
    lake.write_bronze(d.payment(), "payment", mode="overwrite")
    return lake.read_bronze("payment", PAYMENT_SCHEMA).select(*d.payment().columns)


@check("snk_04_bronze_append", PAYMENT_SQL)
def snk_04_bronze_append(d):
    lake, rows = _lake(d), d.payment()
    lake.write_bronze(rows.filter("year(payment_date) < 1998"), "payment")
    lake.write_bronze(rows.filter("year(payment_date) >= 1998"), "payment")
    return lake.read_bronze("payment", PAYMENT_SCHEMA).select(*rows.columns)


@check("snk_05_silver", PAYMENT_SQL + " where amount > 0")
def snk_05_silver(d):
    lake = _lake(d)
    lake.write_silver(d.payment().filter("amount > 0"), "payment")
    return without_stamps(lake.read_silver("payment").filter("_quality_check = 'passed'"))


@check("snk_06_gold_partitioned", REGISTRY["monthly_revenue"].sql)
def snk_06_gold_partitioned(d):
    lake = _lake(d)
    revenue = marts.monthly_revenue(d.payment(), d.rental_line(), d.film())
    lake.write_gold(revenue, "monthly_revenue", ["year", "month"], sort_by=["rating"])
    return without_stamps(lake.read_gold("monthly_revenue"))


MONTHS = "select year(o_orderdate) as year, month(o_orderdate) as month, {} from orders {} group by 1, 2"


@check(
    "snk_07_gold_refresh",
    MONTHS.format("count(*) as n", "where year(o_orderdate) <> 1997")
    + " union all "
    + MONTHS.format("count(*) * 2 as n", "where year(o_orderdate) = 1997"),
)
def snk_07_gold_refresh(d):
    lake = _lake(d)
    counts = d.payment().groupBy(*marts.period("payment_date")).agg(F.count("*").alias("n"))
    lake.write_gold(counts, "months", ["year", "month"])
    # A correction of one year must replace that year's partitions only.
    corrected = counts.filter("year = 1997").withColumn("n", F.col("n") * 2)
    lake.write_gold(corrected, "months", ["year", "month"], mode="partitions")
    return without_stamps(lake.read_gold("months"))


@check(
    "snk_11_row_counts",
    "select 'payment' as table_name, count(*) as n_rows from orders "
    "union all select 'film', count(*) from part",
)
def snk_11_row_counts(d):
    lake = _lake(d)
    done = {"payment": lake.write_silver(d.payment(), "payment"), "film": lake.write_silver(d.film(), "film")}
    rows = [(name, result.rows) for name, result in done.items()]
    return d.spark.createDataFrame(rows, "table_name string, n_rows bigint")


SCHEMAS = {
    "customer": (
        "customer_id bigint, first_name string, last_name string, email string, store_id bigint, active boolean"
    ),
    "payment": PAYMENT_SCHEMA,
    "rental": (
        "rental_id bigint, line_number bigint, film_id bigint, store_id bigint, customer_id bigint, "
        "rental_date timestamp_ntz, return_date timestamp_ntz"
    ),
    "film": (
        "film_id bigint, title string, description string, rating string, rental_rate decimal(18,2), "
        "replacement_cost decimal(18,2), rental_duration int, length int"
    ),
}


def _rules():
    rules = {name: replace(rule, newest=()) for name, rule in default_rules().items() if name in SCHEMAS}
    rules["rental"] = replace(rules["rental"], key=("rental_id", "line_number"), newest=COPY_KEY)
    return rules


def _refined(d) -> Lake:
    """Raw and cleaned layers of the rental store."""
    lake = _lake(d)
    source = FrameSource(
        {
            "customer": lambda: d.customer().drop("credit", "address_id"),
            "payment": d.payment,
            "rental": lambda: d.rental().drop("days_kept"),
            "film": d.film,
        }
    )
    landed = medallion.run_bronze(lake, source)
    refined = medallion.run_silver(lake, SCHEMAS, _rules())
    failed = [s for s in [*landed, *refined] if not s.ok]
    if failed:
        raise RuntimeError(str(failed))
    return lake


SILVER = """silver_rental as (
    select * from rental qualify row_number() over (partition by rental_id, line_number
        order by film_id desc, store_id desc, return_date desc nulls last) = 1)"""


@check(
    "med_02_cleaned_rentals",
    having("rental")
    + f""", {SILVER} select rental_id, line_number, film_id, store_id, customer_id,
        {day('rental_date')} as rental_day, {day('return_date')} as return_day,
        cast(days_kept as double) as rental_duration_days from silver_rental""",
)
def med_02_cleaned_rentals(d):
    rows = without_stamps(_refined(d).read_silver("rental"))
    return rows.select(
        "rental_id", "line_number", "film_id", "store_id", "customer_id",
        F.to_date("rental_date").alias("rental_day"),
        F.to_date("return_date").alias("return_day"),
        "rental_duration_days",
    )


@check(
    "med_03_gold_tables",
    having("payment", "rental", "film", "cust")
    + f""", {SILVER},
    revenue as (
        select rating, cast(sum(amount) as double) as total, count(*) as n
        from payment join silver_rental using (rental_id) join film using (film_id) group by 1),
    stores as (
        select store_id, count(r.rental_id) as n, cast(sum(amount) as double) as total
        from silver_rental r left join payment p on p.rental_id = r.rental_id group by 1),
    films as (
        select title, count(r.rental_id) as n, cast(sum(amount) as double) as total
        from silver_rental r join film using (film_id) left join payment p on p.rental_id = r.rental_id group by 1),
    buyers as (
        select c.customer_id, s.n, s.total from cust c left join (
            select customer_id, count(*) as n, cast(sum(amount) as double) as total from payment group by 1) s
        using (customer_id))
    select 'monthly_revenue' as gold_table, upper(rating) as label, cast(n as bigint) as n, total from revenue
    union all select 'store_performance', cast(store_id as varchar), n, total from stores
    union all select 'film_performance', title, n, total from films
    union all select 'customer_lifetime_value', cast(customer_id as varchar), n, total from buyers""",
)
def med_03_gold_tables(d):
    lake = _refined(d)
    medallion.run_gold(lake)

    def summed(name, label, n, total):
        totals = lake.read_gold(name).groupBy(F.col(label).cast("string").alias("label"))
        return totals.agg(F.sum(n).alias("n"), F.sum(total).alias("total")).select(
            F.lit(name).alias("gold_table"), "label", "n", "total"
        )

    return (
        summed("monthly_revenue", "rating", "transaction_count", "total_revenue")
        .unionByName(summed("store_performance", "store_id", "total_rentals", "total_revenue"))
        .unionByName(summed("film_performance", "title", "total_rentals", "total_revenue"))
        .unionByName(summed("customer_lifetime_value", "customer_id", "total_transactions", "total_spent"))
    )


@check("med_04_active_demo", REGISTRY["active_customers"].sql)
def med_04_active_demo(d):
    source = FrameSource({"customer": d.customer})
    return without_stamps(medallion.run_demo(_lake(d), source))


@check(
    "med_05_shared_fact",
    having("payment", "rental")
    + """select store_id, cast(sum(amount) as double) as by_store, cast(null as bigint) as film_id from payment
        join rental using (rental_id) group by 1
    union all select null, cast(sum(amount) as double), film_id from payment
        join rental using (rental_id) group by film_id""",
)
def med_05_shared_fact(d):
    fact = materialize(marts.sales_fact(d.payment(), d.rental_line()), "fact")
    stores = fact.groupBy("store_id").agg(F.sum("paid").alias("by_store"))
    films = fact.groupBy("film_id").agg(F.sum("paid").alias("by_store"))
    return stores.unionByName(films, allowMissingColumns=True)


def _layout_sql(name: str, column: str) -> str:
    return f"""select '{name}' as layout, count(*) as partitions, cast(sum(n) as bigint) as n_rows, max(n) as max_rows,
        count(*) filter (where by_date) as touched_by_date, count(*) filter (where by_customer) as touched_by_customer,
        cast((2 * cast(max(n) as hugeint) * count(*) * 100 + sum(n)) // (2 * sum(n)) as double) / 100 as skew_ratio
    from (select {column} as part, count(*) as n, bool_or(o_orderdate = timestamp '1998-03-05') as by_date,
                 bool_or(o_custkey = 77) as by_customer from orders group by 1)"""


@check(
    "med_06_layout_report",
    _layout_sql("by_month", day("date_trunc('month', o_orderdate)"))
    + " union all "
    + _layout_sql("by_priority", "o_orderpriority")
    + " union all "
    + _layout_sql("by_customer", "o_custkey"),
)
def med_06_layout_report(d):
    orders = d.raw("orders")
    return layout_report(
        orders,
        {
            "by_month": F.trunc("o_orderdate", "month"),
            "by_priority": F.col("o_orderpriority"),
            "by_customer": F.col("o_custkey"),
        },
        {
            "date": F.col("o_orderdate") == F.lit("1998-03-05").cast("timestamp_ntz"),
            "customer": F.col("o_custkey") == 77,
        },
    )


def _store_layout_sql(name: str, column: str) -> str:
    return f"""select '{name}' as layout, count(*) as partitions, cast(sum(n) as bigint) as n_rows, max(n) as max_rows,
        count(*) filter (where a) as touched_by_date, count(*) filter (where b) as touched_by_store,
        count(*) filter (where c) as touched_by_customer,
        cast((2 * cast(max(n) as hugeint) * count(*) * 100 + sum(n)) // (2 * sum(n)) as double) / 100 as skew_ratio
    from (select {column} as part, count(*) as n, bool_or(rental_date = timestamp '1998-03-05') as a,
                 bool_or(store_id = 3) as b, bool_or(customer_id = 77) as c from rental group by 1)"""


@check(
    "med_06_layout_by_store",
    having("rental")
    + _store_layout_sql("by_month", day("date_trunc('month', rental_date)"))
    + " union all "
    + _store_layout_sql("by_store", "store_id")
    + " union all "
    + _store_layout_sql("by_customer", "customer_id"),
)
def med_06_layout_by_store(d):
    return layout_report(
        d.rental(),
        {
            "by_month": F.trunc("rental_date", "month"),
            "by_store": F.col("store_id"),
            "by_customer": F.col("customer_id"),
        },
        {
            "date": F.col("rental_date") == F.lit("1998-03-05").cast("timestamp_ntz"),
            "store": F.col("store_id") == 3,
            "customer": F.col("customer_id") == 77,
        },
    )


# The same rentals in curve order and by date. Which filters leave out at least a quarter of
# the files is read from the footers: all three of the curve, the date alone of the other.
PROBES = """probes(probe, n_matching) as (
    select 'date', count(*) from rental where rental_date >= timestamp '1998-03-01 00:00:00'
        and rental_date <= timestamp '1998-03-15 00:00:00'
    union all select 'store', count(*) from rental where store_id = 3
    union all select 'customer', count(*) from rental where customer_id = 77)"""


@check(
    "med_06_curve_layout",
    having("rental")
    + f""", {PROBES}
    select layout, probe, layout = 'curve' or probe = 'date' as is_selective, true as holds_all,
           (select count(*) from rental) as n_rows, n_matching
    from probes, (values ('curve'), ('by_date')) l(layout)""",
)
def med_06_curve_layout(d):
    rental = d.rental()
    columns = ["rental_date", "store_id", "customer_id"]
    first, last = dt.datetime(1998, 3, 1), dt.datetime(1998, 3, 15)
    probes = {
        "date": {"rental_date": (first, last)},
        "store": {"store_id": (3, 3)},
        "customer": {"customer_id": (77, 77)},
    }
    root = scratch_path(d.spark, "curve")
    curve.write_curve(rental, f"{root}/curve", columns, 64)
    curve.write_ordered(rental, f"{root}/by_date", columns[:1], 64)
    parts = []
    for layout in ("curve", "by_date"):
        stored = d.spark.read.parquet(f"{root}/{layout}")
        matching = stored.agg(
            F.count_if(F.col("rental_date").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))).alias("date"),
            F.count_if(F.col("store_id") == 3).alias("store"),
            F.count_if(F.col("customer_id") == 77).alias("customer"),
        ).unpivot([], list(probes), "probe", "n_matching")
        report = curve.touched(d.spark, f"{root}/{layout}", probes).join(matching, "probe")
        parts.append(
            report.select(
                F.lit(layout).alias("layout"),
                "probe",
                (F.col("files_touched") * 4 <= F.col("files") * 3).alias("is_selective"),
                (F.col("rows_touched") >= F.col("n_matching")).alias("holds_all"),
                "n_rows",
                "n_matching",
            )
        )
    return parts[0].unionByName(parts[1])


@check(
    "med_07_pruned_read",
    having("payment")
    + """select customer_id, cast(sum(amount) as double) as total, count(*) as n from payment
    where year(payment_date) = 1997 and month(payment_date) = 6 group by 1""",
)
def med_07_pruned_read(d):
    lake = _lake(d)
    years, months = marts.period("payment_date")
    lake.write_gold(d.payment().select("*", years, months), "payments", ["year", "month"])
    june = lake.read_gold("payments").filter("year = 1997 and month = 6")
    return june.groupBy("customer_id").agg(F.sum("amount").alias("total"), F.count("*").alias("n"))
