"""Cleaning rules, quality reports and constraint checks on dirtied tables."""

from dataclasses import replace
from itertools import combinations

from lakeloom.checks.registry import check, day, having, stamp
from lakeloom.functions.money import money
from lakeloom.functions.text import EMAIL_PATTERN
from lakeloom.operators import discovery, profiles, quality
from lakeloom.session import materialize, scratch_path
from lakeloom.sources.schemas import struct
from pyspark.sql import functions as F

# Bad values are put in by key, so every row of the table takes part.
DIRTY_CUSTOMER = """dirty as (
    select c_custkey - case when c_custkey % 20 = 1 then 1 else 0 end as customer_id, c_nationkey as store_id,
        ' ' || split_part(c_name, '#', 1) || '  ' as first_name, split_part(c_name, '#', 2) as last_name,
        case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then 'no address'
             else '  C.' || c_custkey || '@' || c_mktsegment || '.Example.com ' end as email,
        case when c_custkey % 5 = 0 then null else c_acctbal > 0 end as active,
        timestamp '2024-01-01' + to_hours(cast(c_custkey % 24 as integer)) as last_update
    from customer)"""


def _dirty_customer(d):
    key = F.col("c_custkey")
    mail = F.concat(F.lit("  C."), key.cast("string"), F.lit("@"), "c_mktsegment", F.lit(".Example.com "))
    return d.raw("customer").select(
        (key - F.when(key % 20 == 1, 1).otherwise(0)).alias("customer_id"),
        F.col("c_nationkey").alias("store_id"),
        F.concat(F.lit(" "), F.split("c_name", "#")[0], F.lit("  ")).alias("first_name"),
        F.split("c_name", "#")[1].alias("last_name"),
        F.when(key % 11 == 0, None).when(key % 7 == 0, "no address").otherwise(mail).alias("email"),
        F.when(key % 5 == 0, None).otherwise(F.col("c_acctbal") > 0).alias("active"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("last_update"),
    )


CLEAN_CUSTOMER = f"""cleaned as (
    select customer_id, cast(store_id as bigint) as store_id, trim(first_name) as first_name,
           trim(last_name) as last_name, lower(trim(email)) as email, coalesce(active, true) as active, last_update
    from dirty where customer_id is not null and regexp_full_match(lower(trim(email)), '{EMAIL_PATTERN}')
    qualify row_number() over (partition by customer_id order by last_update desc, store_id desc,
        first_name desc, last_name desc, email desc) = 1)"""


@check(
    "dq_01_clean_customer",
    f"""with {DIRTY_CUSTOMER}, {CLEAN_CUSTOMER}
    select customer_id, store_id, first_name, last_name, email, active, {stamp('last_update')} as last_update
    from cleaned""",
)
def dq_01_clean_customer(d):
    return quality.clean(_dirty_customer(d), quality.default_rules()["customer"])


# Order and line number repeat in this table; the newest line stays.
@check(
    "dq_02_clean_rental",
    having("rental")
    + f"""select rental_id, line_number, film_id, store_id, cast(days_kept as bigint) as days_kept, customer_id,
        {stamp('rental_date')} as rental_date, {stamp('return_date')} as return_date,
        cast(days_kept as double) as rental_duration_days
    from (select * replace (nullif(customer_id, 7) as customer_id) from rental)
    where rental_id is not null and customer_id is not null and rental_date is not null
    qualify row_number() over (partition by rental_id, line_number order by film_id desc, store_id desc,
        days_kept desc nulls last) = 1""",
)
def dq_02_clean_rental(d):
    rules = replace(
        quality.default_rules()["rental"], key=("rental_id", "line_number"), newest=("film_id", "store_id")
    )
    return quality.clean(d.rental().withColumn("customer_id", F.nullif("customer_id", F.lit(7))), rules)


DIRTY_PAYMENT = """dirty as (
    select nullif(o_orderkey - case when o_orderkey % 10 = 3 then 1 else 0 end, 40) as payment_id,
        o_custkey as customer_id,
        cast(case when o_orderkey % 17 = 0 then null when o_orderkey % 13 = 0 then -o_totalprice
                  when o_orderkey % 19 = 0 then 0 else o_totalprice end as decimal(18,2)) as amount,
        o_orderdate as last_update
    from orders)"""


def _dirty_payment(d):
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    amount = F.when(key % 17 == 0, None).when(key % 13 == 0, -price).when(key % 19 == 0, 0.0).otherwise(price)
    return d.raw("orders").select(
        F.nullif(key - F.when(key % 10 == 3, 1).otherwise(0), F.lit(40)).alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        money(amount).alias("amount"),
        F.col("o_orderdate").alias("last_update"),
    )


@check(
    "dq_03_clean_payment",
    f"""with {DIRTY_PAYMENT}
    select payment_id, customer_id, cast(amount as double) as amount, {stamp('last_update')} as last_update
    from dirty where payment_id is not null and amount is not null and amount > 0
    qualify row_number() over (partition by payment_id order by last_update desc, customer_id desc, amount desc) = 1""",
)
def dq_03_clean_payment(d):
    return quality.clean(_dirty_payment(d), quality.default_rules()["payment"])


@check(
    "dq_04_clean_film",
    """with dirty as (select p_partkey // 2 as film_id, ' ' || nullif(p_name, 'red widget') || ' ' as title,
        nullif(p_brand, 'Brand#2') as rating, p_retailprice as rental_rate from part)
    select film_id, trim(title) as title, upper(trim(coalesce(rating, 'G'))) as rating, rental_rate
    from dirty where film_id is not null and title is not null
    qualify row_number() over (partition by film_id order by rental_rate desc, trim(title) desc) = 1""",
)
def dq_04_clean_film(d):
    films = d.raw("part").select(
        F.floor(F.col("p_partkey") / 2).alias("film_id"),
        F.concat(F.lit(" "), F.nullif("p_name", F.lit("red widget")), F.lit(" ")).alias("title"),
        F.nullif("p_brand", F.lit("Brand#2")).alias("rating"),
        F.col("p_retailprice").alias("rental_rate"),
    )
    return quality.clean(films, replace(quality.default_rules()["film"], newest=("rental_rate",)))


@check(
    "dq_05_clean_category",
    "select distinct nullif(p_type, 'SMALL') as category_id, p_type as name from part where p_type <> 'SMALL'",
)
def dq_05_clean_category(d):
    padded = F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("name")
    rows = d.raw("part").select(F.nullif("p_type", F.lit("SMALL")).alias("category_id"), padded)
    return quality.clean(rows, quality.default_rules()["category"])


@check(
    "dq_06_clean_inventory",
    """select l_suppkey as inventory_id, max(l_partkey) as film_id from lineitem where l_partkey <> 11 group by 1""",
)
def dq_06_clean_inventory(d):
    rows = d.raw("lineitem").select(
        F.col("l_suppkey").alias("inventory_id"), F.nullif("l_partkey", F.lit(11)).alias("film_id")
    )
    return quality.clean(rows, quality.default_rules()["inventory"])


@check(
    "quality_report",
    f"""with {DIRTY_PAYMENT}, flagged as (
        select *, coalesce(payment_id is not null and amount is not null and amount > 0, false) as ok from dirty)
    select 'payment' as table_name, count(*) as rows_in,
        count(distinct payment_id) filter (where ok) as rows_out,
        count(*) - count(distinct payment_id) filter (where ok) as rows_dropped,
        count(*) filter (where ok) - count(distinct payment_id) filter (where ok) as duplicates,
        count(*) filter (where payment_id is null) as failed_payment_id_missing,
        count(*) filter (where amount is null) as failed_amount_missing,
        count(*) filter (where not coalesce(amount > 0, false)) as failed_amount_not_positive
    from flagged""",
)
def quality_report(d):
    return quality.quality_report(_dirty_payment(d), quality.default_rules()["payment"], "payment")


@check(
    "dq_09_rejected_rows",
    f"""with {DIRTY_PAYMENT}
    select payment_id, customer_id, cast(amount as double) as amount, {stamp('last_update')} as last_update,
        case when payment_id is null then 'payment_id_missing' when amount is null then 'amount_missing'
             else 'amount_not_positive' end as _reject_reason
    from dirty where payment_id is null or amount is null or amount <= 0""",
)
def dq_09_rejected_rows(d):
    return quality.split_valid(_dirty_payment(d), quality.default_rules()["payment"])[1]


@check(
    "orphans",
    """select 'lineitem.l_partkey' as relation, count(*) as orphan_rows, count(distinct l_partkey) as orphan_keys
    from lineitem where l_partkey not in (select p_partkey from part where p_size > 10)""",
)
def orphans(d):
    return quality.check_fk(
        d.raw("lineitem").select("l_partkey"),
        d.raw("part").filter("p_size > 10"),
        ["l_partkey"],
        ["p_partkey"],
        "lineitem.l_partkey",
    )


@check(
    "duplicate_keys",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as n_rows
    from lineitem group by 1, 2 having count(*) > 1""",
)
def duplicate_keys(d):
    return quality.check_unique(d.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "dq_12_domain",
    """select o_orderpriority as value, count(*) as n_rows from orders
    where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""",
)
def dq_12_domain(d):
    return quality.check_domain(d.raw("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@check(
    "dq_12_columns",
    """select count(*) filter (where nullif(lang, 'fr') is null) as lang_null,
        count(*) filter (where length(text) > 1000) as text_too_long from documents""",
)
def dq_12_columns(d):
    rows = d.raw("documents").withColumn("lang", F.nullif("lang", F.lit("fr")))
    return quality.check_columns(rows, not_null=["lang"], max_length={"text": 1000})


CLOSED = "(select c_custkey from customer where c_acctbal < 0)"


def _closed(d):
    return d.raw("customer").filter("c_acctbal < 0").select("c_custkey")


@check("dq_13_delete_cascade", f"select o_orderkey, o_custkey from orders where o_custkey not in {CLOSED}")
def dq_13_delete_cascade(d):
    rows = d.raw("orders").select("o_orderkey", "o_custkey")
    return quality.apply_fk_delete(rows, _closed(d), "o_custkey", "c_custkey", "cascade")


@check("dq_13_delete_restrict", f"select o_orderkey, o_custkey from orders where o_custkey in {CLOSED}")
def dq_13_delete_restrict(d):
    rows = d.raw("orders").select("o_orderkey", "o_custkey")
    return quality.apply_fk_delete(rows, _closed(d), "o_custkey", "c_custkey", "restrict")


@check(
    "dq_13_delete_set_null",
    f"select o_orderkey, case when o_custkey not in {CLOSED} then o_custkey end as o_custkey from orders",
)
def dq_13_delete_set_null(d):
    rows = d.raw("orders").select("o_orderkey", "o_custkey")
    return quality.apply_fk_delete(rows, _closed(d), "o_custkey", "c_custkey", "set_null")


@check(
    "dq_13_update_cascade",
    f"""select o_orderkey, case when o_custkey in {CLOSED} then o_custkey + 1000000 else o_custkey end as o_custkey
    from orders""",
)
def dq_13_update_cascade(d):
    moves = _closed(d).withColumn("new_key", F.col("c_custkey") + 1000000)
    rows = d.raw("orders").select("o_orderkey", "o_custkey")
    return quality.apply_fk_update(rows, moves, "o_custkey", "c_custkey", "new_key")


@check(
    "dq_14_conform",
    f"""select event_id, try_cast(case when event_type = 'error' then 'x' else cast(user_id as varchar) end as bigint)
        as user_id, {day('ts')} as day, cast(null as varchar) as note,
        case when event_type = 'error' then 'user_id' else '' end as bad from events""",
)
def dq_14_conform(d):
    loose = d.events().select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "x").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.lit("extra").alias("extra"),
    )
    typed = quality.conform(loose, struct("event_id bigint, user_id bigint, day date, note string"))
    return typed.withColumn("bad", F.array_join("_bad_columns", ",")).drop("_bad_columns")


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")


def _unique_sql():
    """Every set of up to three columns; the unique ones without a unique subset."""
    sets = [c for n in (1, 2, 3) for c in combinations(LINE_COLUMNS, n)]
    tests = [
        f"select [{', '.join(repr(x) for x in c)}] as columns, "
        f"(select count(*) from (select distinct {', '.join(c)} from lineitem)) = (select count(*) from lineitem) as whole"
        for c in sets
    ]
    return f"""with tried as ({' union all '.join(tests)}),
    good as (select columns from tried where whole)
    select array_to_string(columns, ',') as columns from good g
    where not exists (select * from good h where len(h.columns) < len(g.columns) and list_has_all(g.columns, h.columns))"""


@check("dq_11_found_keys", _unique_sql())
def dq_11_found_keys(d):
    found = discovery.unique_sets(d.raw("lineitem").select(*LINE_COLUMNS))
    return found.select(F.array_join("columns", ",").alias("columns"))


KEY_COLUMNS = {
    "customer": ("c_custkey", "c_nationkey"),
    "nation": ("n_nationkey", "n_regionkey"),
    "region": ("r_regionkey", "r_name"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus"),
    "part": ("p_partkey", "p_name"),
    "supplier": ("s_suppkey", "s_nationkey"),
}


def _inclusion_sql():
    """Every pair of columns of a kind, by set difference."""
    text = {"r_name", "o_orderstatus", "l_linestatus", "p_name"}
    columns = [(t, c) for t, cs in KEY_COLUMNS.items() for c in cs]
    pairs = [
        f"select '{t}' as child_table, '{c}' as child, '{u}' as parent_table, '{e}' as parent, "
        f"(select count(distinct {c}) from {t}) as n_values where not exists (select {c} from {t} except select {e} from {u})"
        for t, c in columns for u, e in columns if (t, c) != (u, e) and (c in text) == (e in text)
    ]
    return " union all ".join(pairs)


@check("dq_10_found_references", _inclusion_sql())
def dq_10_found_references(d):
    return discovery.inclusions({t: d.raw(t).select(*cs) for t, cs in KEY_COLUMNS.items()})


# Orders come in four loads; the profile of the table is merged from those of the loads.
PROFILED = ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _profiled(d):
    path = scratch_path(d.spark, "profiles")
    orders = d.raw("orders")
    for load in range(4):
        profiles.store_profile(orders.filter(F.col("o_orderkey") % 4 == load), path, load, PROFILED)
    return profiles.merged(d.spark, path)


@check(
    "dq_08_merged_profile",
    """select 'o_custkey' as "column", count(*) as n_rows, count(*) - count(o_custkey) as nulls,
        cast(cast(min(o_custkey) as double) as varchar) as lowest, cast(cast(max(o_custkey) as double) as varchar) as highest,
        true as distinct_is_close, true as median_is_close from orders
    union all select 'o_totalprice', count(*), count(*) - count(o_totalprice), cast(min(o_totalprice) as varchar),
        cast(max(o_totalprice) as varchar), true, true from orders
    union all select 'o_orderpriority', count(*), count(*) - count(o_orderpriority), min(o_orderpriority),
        max(o_orderpriority), true, null from orders""",
)
def dq_08_merged_profile(d):
    merged = materialize(_profiled(d).filter("column <> 'o_orderdate'"), "profile")
    found = profiles.describe(merged, [0.5])
    values = d.raw("orders").select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_text"), x.alias("_x"))
                    for c, x in (
                        ("o_custkey", F.col("o_custkey").cast("double")),
                        ("o_totalprice", F.col("o_totalprice")),
                        ("o_orderpriority", F.lit(None).cast("double")),
                    )
                ]
            )
        )
    )
    median = found.select("column", F.col("quantiles")[0].alias("_median"))
    exact = values.join(median, "column").groupBy("column").agg(
        F.count_distinct("_text").alias("_distinct"),
        F.count_if(F.col("_x") <= F.col("_median")).alias("_upto"),
        F.count_if(F.col("_x") >= F.col("_median")).alias("_from"),
    )
    return found.join(exact, "column").select(
        "column",
        "n_rows",
        "nulls",
        "lowest",
        "highest",
        (F.abs(F.col("n_distinct") - F.col("_distinct")) <= 0.05 * F.col("_distinct")).alias("distinct_is_close"),
        F.when(
            F.col("quantiles").isNotNull(), F.least("_upto", "_from") >= 0.48 * (F.col("n_rows") - F.col("nulls"))
        ).alias("median_is_close"),
    )


@check(
    "dq_08_frequent_values",
    """select 'o_orderpriority' as "column", o_orderpriority as value, count(*) as n from orders
    where o_orderpriority is not null group by 2""",
)
def dq_08_frequent_values(d):
    merged = _profiled(d).filter("column = 'o_orderpriority'")
    return profiles.frequent_values(merged, 100)


# The later load has no urgent orders of odd numbers, no known price of some and higher prices.
@check(
    "dq_08_drift",
    """with loads as (
        select o_orderkey % 2 as later, o_custkey, o_orderdate,
               case when o_orderkey % 2 = 0 then o_totalprice when o_orderkey % 5 > 0 then o_totalprice * 2 end as o_totalprice,
               case when o_orderkey % 2 = 1 and o_orderpriority = '1-URGENT' then '0-NONE' else o_orderpriority end as o_orderpriority
        from orders),
    size as (select count(*) filter (where later = 0) as a, count(*) filter (where later = 1) as b from loads),
    shares as (
        select o_orderpriority, count(*) filter (where later = 0) as n, count(*) filter (where later = 1) as m
        from loads group by 1)
    select 'o_custkey' as "column", cast(null as double) as distance, false as drifted
    union all select 'o_orderdate', null, false
    union all select 'o_totalprice', null, true
    union all select 'o_orderpriority', round(sum(abs(n / a - m / b)) / 2, 6), sum(abs(n / a - m / b)) / 2 > 0.1
    from shares, size""",
)
def dq_08_drift(d):
    later = F.col("o_orderkey") % 2
    orders = d.raw("orders")
    price = F.when(later == 0, F.col("o_totalprice")).when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice") * 2)
    urgent = (later == 1) & (F.col("o_orderpriority") == "1-URGENT")
    changed = orders.withColumns(
        {"o_totalprice": price, "o_orderpriority": F.when(urgent, "0-NONE").otherwise(F.col("o_orderpriority"))}
    )
    path = scratch_path(d.spark, "drift")
    for load in (0, 1):
        profiles.store_profile(changed.filter(later == load), path, load, PROFILED)
    found = profiles.drift(profiles.merged(d.spark, path, [0]), profiles.merged(d.spark, path, [1]))
    exact = F.when(F.col("column") == "o_orderpriority", F.round("distance", 6))
    return found.select("column", exact.alias("distance"), "drifted")
