"""Lists, routines and stock reports."""

from lakeloom.checks.registry import check, day, having, stamp
from lakeloom.operators.ranking import top_rows
from lakeloom.operators.relational import search
from lakeloom.plans import reports
from lakeloom.plans.binding import COPY_KEY
from lakeloom.session import scratch_path
from lakeloom.sources.federation import federated
from lakeloom.sources.relational import FolderSource, import_table
from pyspark.sql import functions as F

ADDRESS_SQL = """places as (
    select cast(n_nationkey as bigint) as address_id, 'Main street ' || n_nationkey as address,
           lpad(cast(n_nationkey as varchar), 5, '0') as "zip code", '+' || n_nationkey as phone,
           n_name as city, r_name as country
    from nation join region on n_regionkey = r_regionkey)
"""


@check(
    "customer_list",
    having("cust") + ", " + ADDRESS_SQL
    + """select customer_id as "ID", first_name || ' ' || last_name as name, address, "zip code", phone,
           city, country, case when active then 'active' else '' end as notes, store_id as "SID"
    from cust join places on address_id = store_id""",
)
def customer_list(d):
    return reports.customer_list(d.customer(), d.address(), d.city(), d.country())


@check(
    "staff_list",
    "with " + ADDRESS_SQL
    + """select s_suppkey as "ID", replace(s_name, '#', ' ') as name, address, "zip code", phone, city,
           country, s_suppkey as "SID"
    from supplier join places on address_id = s_nationkey""",
)
def staff_list(d):
    return reports.staff_list(d.staff(), d.address(), d.city(), d.country())


def _film_list_sql(name: str) -> str:
    return having("film", "film_category", "film_actor", "actor") + f"""
    , names as (select film_id, string_agg({name}, ', ' order by {name}) as actors
                from film_actor join actor using (actor_id) group by 1)
    select film_id as "FID", title, description, category, cast(rental_rate as double) as price,
           cast(length as bigint) as length, rating, actors
    from film left join film_category using (film_id) left join names using (film_id)"""


@check("film_list", _film_list_sql("first_name || ' ' || last_name"))
def film_list(d):
    return reports.film_list(d.film(), d.film_category(), d.film_actor(), d.actor())


@check(
    "film_list_formatted",
    _film_list_sql("upper(first_name[1]) || lower(first_name[2:]) || ' ' || last_name"),
)
def film_list_formatted(d):
    return reports.film_list(d.film(), d.film_category(), d.film_actor(), d.actor(), formatted=True)


@check(
    "actor_info",
    having("film", "film_category", "film_actor", "actor")
    + """, entries as (
        select actor_id, category, category || ': ' || string_agg(title, ', ' order by title) as entry
        from film_actor join film using (film_id) join film_category using (film_id) group by 1, 2),
    info as (select actor_id, string_agg(entry, '; ' order by category) as film_info
             from entries group by 1)
    select actor_id, first_name, last_name, film_info from actor left join info using (actor_id)""",
)
def actor_info(d):
    return reports.actor_info(d.actor(), d.film_actor(), d.film_category(), d.film())


@check(
    "sales_by_store",
    having("payment", "rental", "inventory")
    + """select n_name || ',' || r_name as store, replace(s_name, '#', ' ') as manager,
           cast(sum(amount) as double) as total_sales
    from payment join rental using (rental_id) join inventory using (film_id, store_id)
    join supplier on store_id = s_suppkey join nation on s_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    group by store_id, n_name, r_name, s_name""",
)
def sales_by_store(d):
    return reports.sales_by_store(
        d.payment(), d.rental_line(), d.store(), d.staff(), d.address(), d.city(), d.country(),
        unique=True,
    )


@check(
    "sales_by_film_category",
    having("payment", "rental", "inventory", "film", "film_category")
    + """select category, cast(sum(amount) as double) as total_sales
    from payment join rental using (rental_id) join inventory using (film_id, store_id)
    join film using (film_id) join film_category using (film_id) group by 1""",
)
def sales_by_film_category(d):
    return reports.sales_by_film_category(
        d.payment(), d.rental_line(), d.film_category(), unique=True
    )


@check(
    "rewards_report",
    having("payment", "cust")
    + """select customer_id, first_name, last_name, email, active from cust
    where customer_id in (
        select customer_id from payment
        where cast(payment_date as date) between date '1998-04-01' and date '1998-04-30'
        group by 1 having sum(amount) > 250000 and count(*) > 1)""",
)
def rewards_report(d):
    good = reports.rewards(d.customer(), d.payment(), "1998-05-17", 1, 250000)
    return good.select("customer_id", "first_name", "last_name", "email", "active")


AS_OF = "1998-06-30"


@check(
    "customer_balance",
    having("payment", "rental", "film", "cust")
    + f""", owed as (
        select customer_id, sum(rental_rate) as fees,
               sum(case when days_kept > rental_duration then days_kept - rental_duration else 0 end) as late
        from rental join film using (film_id)
        where rental_date <= timestamp '{AS_OF}' group by 1),
    paid as (select customer_id, sum(amount) as paid from payment
             where payment_date <= timestamp '{AS_OF}' group by 1)
    select customer_id, cast(coalesce(fees, 0) as double) as rent_fees,
           cast(coalesce(late, 0) as bigint) as overdue_days, cast(coalesce(paid, 0) as double) as payments,
           cast(coalesce(fees, 0) + coalesce(late, 0) - coalesce(paid, 0) as double) as balance
    from cust left join owed using (customer_id) left join paid using (customer_id)""",
)
def customer_balance(d):
    return reports.balances(d.customer(), d.rental(), d.film(), d.payment(), AS_OF)


@check(
    "customer_balances_at",
    having("payment", "rental", "film", "cust")
    + f""", entries as (
        select customer_id, rental_date as moment, rental_rate as fee,
               case when days_kept > rental_duration then days_kept - rental_duration else 0 end as late, 0.00 as paid
        from rental join film using (film_id)
        union all select customer_id, payment_date, 0, 0, amount from payment),
    asked as (
        select customer_id, payment_date as moment from payment union select customer_id, timestamp '{AS_OF}' from cust),
    totals as (
        select a.customer_id, a.moment, coalesce(sum(fee), 0) as fees, coalesce(sum(late), 0) as late, coalesce(sum(paid), 0) as paid
        from asked a left join entries e on e.customer_id = a.customer_id and e.moment <= a.moment group by 1, 2)
    select customer_id, {stamp('moment')} as "at", cast(fees as double) as rent_fees, cast(late as bigint) as overdue_days,
           cast(paid as double) as payments, cast(fees + late - paid as double) as balance
    from totals""",
)
def customer_balances_at(d):
    """Every customer's balance after each payment and at a date."""
    date = F.lit(AS_OF).cast("timestamp_ntz")
    asked = d.payment().select("customer_id", F.col("payment_date").alias("at"))
    asked = asked.unionByName(d.customer().select("customer_id", date.alias("at")))
    return reports.balances_at(asked, d.rental(), d.film(), d.payment())


@check(
    "items_in_stock",
    """select l_partkey as film_id, l_suppkey as store_id from lineitem
    group by 1, 2 having not bool_or(l_linestatus = 'O')""",
)
def items_in_stock(d):
    return reports.items_in_stock(d.inventory(), _lines(d), COPY_KEY)


def _lines(d):
    """Rentals with an open / returned mark; the dates are not needed here."""
    return d.rental_line().withColumnRenamed("days_kept", "return_date")


@check(
    "items_out",
    """select l_partkey as film_id, l_suppkey as store_id from lineitem
    group by 1, 2 having bool_or(l_linestatus = 'O')""",
)
def items_out(d):
    return reports.items_out(d.inventory(), _lines(d), COPY_KEY)


@check(
    "item_holder",
    having("rental", "inventory")
    + """select i.film_id, i.store_id, r.customer_id
    from inventory i left join (
        select * from rental where return_date is null
        qualify row_number() over (partition by film_id, store_id
            order by rental_date desc, rental_id desc, line_number desc) = 1) r
      on r.film_id = i.film_id and r.store_id = i.store_id""",
)
def item_holder(d):
    newest = ("rental_date", "rental_id", "line_number")
    return reports.item_holder(d.inventory(), d.rental(only_open=True), COPY_KEY, newest)


@check(
    "item_in_stock_flag",
    """select l_partkey as film_id, l_suppkey as store_id, not bool_or(l_linestatus = 'O') as in_stock
    from lineitem group by 1, 2""",
)
def item_in_stock_flag(d):
    return reports.stock_flags(d.inventory(), _lines(d), COPY_KEY)


@check(
    "film_stock_by_store",
    """select film_id, store_id, count(*) filter (where in_stock) as copies_in,
           count(*) filter (where not in_stock) as copies_out
    from (select l_partkey as film_id, l_suppkey as store_id, not bool_or(l_linestatus = 'O') as in_stock
          from lineitem group by 1, 2)
    where film_id = 7 group by 1, 2""",
)
def film_stock_by_store(d):
    flags = reports.stock_flags(d.inventory(), _lines(d), COPY_KEY).filter("film_id = 7")
    return flags.groupBy(*COPY_KEY).agg(
        F.count_if("in_stock").alias("copies_in"), F.count_if(~F.col("in_stock")).alias("copies_out")
    )


@check(
    "film_search",
    having("film")
    + """select film_id, title, description from film
    where list_has_all(regexp_split_to_array(lower(title || ' ' || description), '[^\\p{L}\\p{N}]+'),
                       ['red', 'small'])""",
)
def film_search(d):
    films = d.film().select("film_id", "title", "description")
    return search(films, "film_id", ["title", "description"], ["Red", "small"])


@check(
    "films_since",
    f"""select o_orderkey, o_custkey, {day('o_orderdate')} as o_orderdate from orders
    where o_orderdate >= timestamp '1998-01-01'""",
)
def films_since(d):
    rows = import_table(
        d.spark,
        FolderSource(d.folder, ["orders"]),
        "orders",
        where="o_orderdate >= timestamp_ntz'1998-01-01'",
        columns=["o_orderkey", "o_custkey", "o_orderdate"],
    )
    return rows.withColumn("o_orderdate", F.to_date("o_orderdate"))


def _lake_folder(d):
    """Active customers kept as a table of the lake."""
    active = d.customer().filter("active").select("customer_id", "first_name", "last_name")
    return _kept(active, "active")


def _kept(df, label):
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


@check(
    "federated_join",
    having("cust")
    + """select customer_id, first_name, email from cust where active order by customer_id limit 5""",
)
def federated_join(d):
    lake, live = {"lake": {"customer_active": _lake_folder(d)}}, {"live": {"customer": d.customer()}}
    with federated(d.spark, lake, live) as at:
        joined = d.spark.sql(
            f"""select l.customer_id, l.first_name, p.email
            from {at['lake']}.customer_active l join {at['live']}_customer p on l.customer_id = p.customer_id"""
        )
    return top_rows(joined, [F.col("customer_id")], 5)


@check(
    "federated_metrics",
    having("cust", "payment")
    + f"""select first_name, last_name, email, cast(total_spent as double) as total_spent, {stamp('last_seen')} as last_seen
    from cust join (select customer_id, sum(amount) as total_spent, max(payment_date) as last_seen
                    from payment group by 1) using (customer_id)""",
)
def federated_metrics(d):
    metrics = d.payment().groupBy("customer_id").agg(
        F.sum("amount").alias("total_spent"), F.max("payment_date").alias("last_seen")
    )
    gold, live = {"gold": {"customer_metrics": _kept(metrics, "metrics")}}, {"live": {"customer": d.customer()}}
    with federated(d.spark, gold, live) as at:
        return d.spark.sql(
            f"""select c.first_name, c.last_name, c.email, m.total_spent, m.last_seen
            from {at['live']}_customer c join {at['gold']}.customer_metrics m on c.customer_id = m.customer_id"""
        )
