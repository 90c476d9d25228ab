"""Composite business queries."""

from lakeloom.checks.registry import avg2, check, day, having, ratio, stamp
from lakeloom.functions.text import words
from lakeloom.plans import marts
from pyspark.sql import functions as F


@check(
    "monthly_revenue",
    having("payment", "rental", "film")
    + f"""select cast(year(payment_date) as bigint) as year, cast(month(payment_date) as bigint) as month,
           rating, cast(sum(amount) as double) as total_revenue, count(*) as transaction_count,
           {avg2('sum(amount)', 'count(amount)')} as avg_transaction
    from payment join rental using (rental_id) join film using (film_id)
    group by 1, 2, 3""",
)
def monthly_revenue(d):
    return marts.monthly_revenue(d.payment(), d.rental_line(), d.film(), unique=True)


@check(
    "monthly_revenue_by_category",
    having("payment", "rental", "film_category")
    + f"""select cast(year(payment_date) as bigint) as year, cast(month(payment_date) as bigint) as month,
           category, cast(sum(amount) as double) as total_revenue, count(*) as transaction_count,
           {avg2('sum(amount)', 'count(amount)')} as avg_transaction
    from payment join rental using (rental_id) join film_category using (film_id)
    group by 1, 2, 3""",
)
def monthly_revenue_by_category(d):
    return marts.monthly_revenue_by_category(d.payment(), d.rental_line(), d.film_category(), unique=True)


@check(
    "customer_lifetime_value",
    having("payment", "rental", "cust")
    + f""", spent as (
        select customer_id, sum(amount) as total_spent, count(*) as total_transactions,
               {avg2('sum(amount)', 'count(amount)')} as avg_transaction_value,
               min(payment_date) as first_payment, max(payment_date) as last_payment
        from payment group by 1),
    rented as (select customer_id, count(*) as total_rentals from rental group by 1),
    ranked as (
        select c.*, s.* exclude (customer_id), r.total_rentals,
               dense_rank() over (order by total_spent desc nulls last) as clv_rank,
               rank() over (order by total_spent desc nulls last) - 1 as ahead,
               count(*) over () - 1 as others
        from cust c left join spent s using (customer_id) left join rented r using (customer_id))
    select customer_id, first_name, last_name, email, cast(total_spent as double) as total_spent,
           total_transactions, total_rentals, avg_transaction_value,
           {stamp('first_payment')} as first_payment_date, {stamp('last_payment')} as last_payment_date,
           clv_rank, {ratio('ahead * 100', 'others')} as clv_percentile
    from ranked""",
)
def customer_lifetime_value(d):
    return marts.customer_lifetime_value(d.customer(), d.payment(), d.rental())


@check(
    "film_performance",
    having("payment", "rental", "film")
    + f""", totals as (
        select film_id, title, rating, rental_rate, replacement_cost,
               count(r.rental_id) as total_rentals, sum(amount) as revenue,
               {avg2('sum(amount)', 'count(amount)')} as avg_revenue_per_rental
        from rental r join film using (film_id) left join payment p on p.rental_id = r.rental_id
        group by all)
    select film_id, title, rating, cast(rental_rate as double) as rental_rate,
           cast(replacement_cost as double) as replacement_cost, total_rentals,
           cast(revenue as double) as total_revenue, avg_revenue_per_rental,
           dense_rank() over (order by total_rentals desc nulls last) as popularity_rank
    from totals""",
)
def film_performance(d):
    return marts.film_performance(d.rental_line(), d.film(), d.payment(), unique=True)


@check(
    "store_performance",
    having("payment", "rental")
    + f"""select store_id, cast(year(rental_date) as bigint) as year,
           cast(month(rental_date) as bigint) as month, count(r.rental_id) as total_rentals,
           cast(sum(amount) as double) as total_revenue,
           {avg2('sum(amount)', 'count(amount)')} as avg_transaction
    from rental r left join payment p on p.rental_id = r.rental_id group by 1, 2, 3""",
)
def store_performance(d):
    return marts.store_performance(d.rental(), d.payment(), unique=True)


@check(
    "product_sales",
    having("sales")
    + """select product, cast(sum(quantity) as bigint) as total_quantity,
           cast(sum(quantity * price) as double) as total_revenue
    from sales group by 1""",
)
def product_sales(d):
    return marts.product_sales(d.sales())


@check(
    "category_sales",
    having("sales")
    + f"""select category, count(*) as transactions, cast(sum(quantity) as bigint) as total_items,
           cast(sum(quantity * price) as double) as total_revenue,
           {avg2('sum(quantity * price)', 'count(*)')} as avg_transaction_value
    from sales group by 1""",
)
def category_sales(d):
    return marts.category_sales(d.sales())


# The orders of every seventh customer count for nobody, so that some customers have none.
@check(
    "customer_order_summary",
    having("customers")
    + f"""select c.customer_id, first_name, last_name, country, count(o_orderkey) as total_orders,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_spent,
           {avg2('sum(cast(o_totalprice as decimal(18,2)))', 'count(o_totalprice)')} as avg_order_value
    from customers c left join orders o
      on case when o_custkey % 7 <> 0 then o_custkey else -1 - o_custkey end = c.customer_id
    group by 1, 2, 3, 4""",
)
def customer_order_summary(d):
    buyer = F.when(F.col("customer_id") % 7 != 0, F.col("customer_id")).otherwise(-1 - F.col("customer_id"))
    return marts.customer_order_summary(d.customers(), d.orders().withColumn("customer_id", buyer))


@check(
    "sales_by_country",
    having("customers")
    + """select country, count(o_orderkey) as total_orders,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_revenue
    from customers join orders on o_custkey = customer_id group by 1""",
)
def sales_by_country(d):
    return marts.sales_by_country(d.customers(), d.orders())


@check(
    "revenue_by_country_month",
    having("customers")
    + f"""select country, {day("date_trunc('month', o_orderdate)")} as month, count(*) as customer_count,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue
    from customers join orders on o_custkey = customer_id group by 1, 2""",
)
def revenue_by_country_month(d):
    return marts.revenue_by_country_month(d.customers(), d.orders())


@check(
    "word_count",
    """select word, count(*) as count
    from (select unnest(string_split(text, ' ')) as word from documents) group by 1""",
)
def word_count(d):
    return marts.word_count(d.raw("documents"), words(F.col("text")))


@check(
    "bucket_aggregate",
    """select l_orderkey % 100 as bucket, count(l_orderkey) as n_rows,
           cast(sum(cast(l_quantity as bigint)) as double) / count(*) as avg_quantity
    from lineitem group by 1""",
)
def bucket_aggregate(d):
    lines = d.raw("lineitem").select("l_orderkey", "l_quantity")
    found = marts.bucket_aggregate(lines, "l_orderkey", "l_quantity")
    return found.select(
        "bucket",
        F.col("count(l_orderkey)").alias("n_rows"),
        F.col("avg(l_quantity)").alias("avg_quantity"),
    )


@check(
    "customers_per_store",
    having("cust") + "select store_id, count(*) as count from cust where active group by 1",
)
def customers_per_store(d):
    return marts.customers_per_store(d.customer())


@check(
    "active_customers",
    having("cust")
    + "select customer_id, first_name, last_name, email, store_id from cust where active",
)
def active_customers(d):
    return marts.active_customers(
        d.customer(), ["customer_id", "first_name", "last_name", "email", "store_id"]
    )
