"""Projections, filters, joins, aggregates and unions."""

from lakeloom.checks.registry import avg2, check, day, having, stamp
from lakeloom.functions.money import average, money
from lakeloom.operators.intervals import interval_labels, rows_below, totals_below
from lakeloom.operators.relational import (
    bucket,
    hierarchy,
    keep_matching,
    keep_missing,
    ordered_list,
    with_parent,
)
from pyspark.sql import functions as F


@check(
    "prj_derived_columns",
    f"""select l_orderkey, cast(l_linenumber as bigint) as line,
        cast(cast(l_quantity as integer) * cast(l_extendedprice as decimal(18,2)) as double) as revenue,
        'import' as source, l_returnflag || '/' || l_linestatus as "line state" from lineitem""",
)
def prj_derived_columns(d):
    return (
        d.raw("lineitem")
        .withColumn("revenue", F.col("l_quantity").cast("int") * money("l_extendedprice"))
        .select(
            "l_orderkey",
            F.col("l_linenumber").alias("line"),
            "revenue",
            F.lit("import").alias("source"),
            F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("line state"),
        )
    )


# NULLs are put in by value, as the tables hold none.
NULLED = "select o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') as priority, o_totalprice, o_orderdate from orders"


def _nulled(d):
    return d.raw("orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_totalprice",
        "o_orderdate",
    )


@check("flt_01_not_null", f"select o_orderkey, priority from ({NULLED}) where priority is not null")
def flt_01_not_null(d):
    return _nulled(d).filter(F.col("priority").isNotNull()).select("o_orderkey", "priority")


@check(
    "flt_02_range",
    f"""select o_orderkey, {day('o_orderdate')} as o_orderdate, o_totalprice from orders
    where o_totalprice > 400000 and o_orderdate between timestamp '1996-03-01' and timestamp '1996-08-31'""",
)
def flt_02_range(d):
    dates = F.col("o_orderdate").between(
        F.lit("1996-03-01").cast("timestamp_ntz"), F.lit("1996-08-31").cast("timestamp_ntz")
    )
    rows = d.raw("orders").filter(F.col("o_totalprice") > 400000).filter(dates)
    return rows.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")


@check(
    "flt_04_text_predicate",
    "select c_custkey, c_acctbal from customer where c_acctbal > 0 and c_mktsegment = 'BUILDING'",
)
def flt_04_text_predicate(d):
    rows = d.raw("customer").filter("c_acctbal > 0 and c_mktsegment = 'BUILDING'")
    return rows.select("c_custkey", "c_acctbal")


@check(
    "flt_05_open_rentals",
    having("rental")
    + f"select rental_id, line_number, film_id, store_id, customer_id, {day('rental_date')} as rented from rental "
    + "where return_date is null",
)
def flt_05_open_rentals(d):
    rows = d.rental(only_open=True)
    return rows.select(
        "rental_id", "line_number", "film_id", "store_id", "customer_id",
        F.to_date("rental_date").alias("rented"),
    )


@check(
    "flt_06_null_safe_change",
    f"""select o_orderkey, priority as old_value, o_orderpriority as new_value
    from ({NULLED}) join (select o_orderkey as k, o_orderpriority from orders) on k = o_orderkey
    where priority is distinct from o_orderpriority""",
)
def flt_06_null_safe_change(d):
    now = d.raw("orders").select("o_orderkey", F.col("o_orderpriority").alias("new_value"))
    both = _nulled(d).select("o_orderkey", F.col("priority").alias("old_value")).join(now, "o_orderkey")
    return both.filter(~F.col("old_value").eqNullSafe(F.col("new_value")))


@check(
    "flt_07_having",
    """select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by 1
    having count(*) > 2 and sum(cast(o_totalprice as decimal(18,2))) > 500000""",
)
def flt_07_having(d):
    rows = d.raw("orders").groupBy("o_custkey")
    totals = rows.agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("total"))
    return totals.filter((F.col("n") > 2) & (F.col("total") > 500000))


@check(
    "jn_01_shared_key",
    """select o_orderkey, count(*) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
    from orders join lineitem on l_orderkey = o_orderkey group by 1""",
)
def jn_01_shared_key(d):
    lines = d.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    per_order = lines.groupBy("o_orderkey").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    return per_order.join(d.raw("orders").select("o_orderkey"), "o_orderkey")


@check(
    "jn_03_left_join",
    """select o_orderkey, count(l_orderkey) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
    from orders left join lineitem on l_orderkey = o_orderkey group by 1""",
)
def jn_03_left_join(d):
    per_order = d.raw("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    orders = d.raw("orders").select("o_orderkey")
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"), "quantity")


@check(
    "jn_11_semi",
    "select o_orderkey, o_custkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def jn_11_semi(d):
    lines = d.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keep_matching(d.raw("orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@check(
    "jn_12_anti",
    "select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def jn_12_anti(d):
    lines = d.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keep_missing(d.raw("orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@check(
    "jn_13_preaggregated_sides",
    """select s_suppkey, s_name, n_lines, n_films from supplier
    left join (select l_suppkey, count(*) as n_lines from lineitem group by 1) a on a.l_suppkey = s_suppkey
    left join (select l_suppkey, count(distinct l_partkey) as n_films from lineitem group by 1) b
      on b.l_suppkey = s_suppkey""",
)
def jn_13_preaggregated_sides(d):
    lines = d.raw("lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey")
    n_lines = lines.groupBy("s_suppkey").agg(F.count("*").alias("n_lines"))
    n_films = lines.distinct().groupBy("s_suppkey").agg(F.count("*").alias("n_films"))
    suppliers = d.raw("supplier").select("s_suppkey", "s_name")
    return suppliers.join(n_lines, "s_suppkey", "left").join(n_films, "s_suppkey", "left")


STAFF_SQL = """team as (
    select c_custkey as id, c_name as name, case when c_custkey > 0 then c_custkey // 10 end as reports_to
    from customer)"""


def _team(d):
    above = F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 10))
    return d.raw("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), above.alias("reports_to")
    )


@check(
    "jn_15_manager",
    f"""with {STAFF_SQL}
    select t.id, t.name, t.reports_to, m.name as manager from team t left join team m on m.id = t.reports_to""",
)
def jn_15_manager(d):
    return with_parent(_team(d), "id", "reports_to", "name", "manager")


WALK_SQL = """levels as (
        select id, reports_to, 0 as depth, 'reached' as state from team where reports_to is null
        union all
        select id, reports_to, cast(null as integer), 'orphan' from team
        where reports_to is not null and reports_to not in (select id from team)
        union all
        select t.id, t.reports_to, depth + 1, l.state from team t join levels l on t.reports_to = l.id)
    select t.id, t.reports_to, cast(l.depth as bigint) as depth, coalesce(l.state, 'cycle') as state
    from team t left join levels l on l.id = t.id"""


@check("jn_15_hierarchy_depth", f"with recursive {STAFF_SQL}, {WALK_SQL}")
def jn_15_hierarchy_depth(d):
    return hierarchy(_team(d), "id", "reports_to")


# Every customer whose number ends in 7 left the team; those ending in 3 report to each other.
GAPS_SQL = """team as (
    select c_custkey as id, case when c_custkey % 10 = 3 then c_custkey - c_custkey % 20 + (c_custkey + 10) % 20
        when c_custkey > 0 then c_custkey // 10 end as reports_to
    from customer where c_custkey % 10 <> 7)"""


def _gaps(d):
    key = F.col("c_custkey")
    above = F.when(key % 10 == 3, key - key % 20 + (key + 10) % 20).when(key > 0, F.floor(key / 10))
    return d.raw("customer").filter(key % 10 != 7).select(key.alias("id"), above.alias("reports_to"))


@check("jn_15_hierarchy_gaps", f"with recursive {GAPS_SQL}, {WALK_SQL}")
def jn_15_hierarchy_gaps(d):
    return hierarchy(_gaps(d), "id", "reports_to")


# Pairs of a team member and everyone below; members in or below a cycle are never reached.
BELOW_SQL = """placed as (
        select id from team where reports_to is null or reports_to not in (select id from team)
        union all select t.id from placed p join team t on t.reports_to = p.id),
    pairs as (
        select id as above, id as below from placed
        union all select above, t.id from pairs join team t on t.reports_to = below)"""


@check(
    "jn_15_interval_labels",
    f"""with recursive {GAPS_SQL}, {BELOW_SQL}
    select t.id, t.reports_to, a.root, a.depth, b.n_below from team t
    left join (select below as id, count(*) - 1 as depth, min(above) filter (where above in (
                   select id from team where reports_to is null or reports_to not in (select id from team))) as root
               from pairs group by 1) a on a.id = t.id
    left join (select above as id, count(*) - 1 as n_below from pairs group by 1) b on b.id = t.id""",
)
def jn_15_interval_labels(d):
    return interval_labels(_gaps(d), "id", "reports_to").drop("low", "high")


@check(
    "jn_15_all_below",
    f"""with recursive {STAFF_SQL}, {BELOW_SQL}
    select above, below from pairs where above <> below""",
)
def jn_15_all_below(d):
    labels = interval_labels(_team(d), "id", "reports_to")
    return rows_below(labels, "id", labels.select("id"))


@check(
    "jn_15_totals_below",
    f"""with recursive {STAFF_SQL}, {BELOW_SQL},
    spent as (select o_custkey as id, sum(cast(o_totalprice as decimal(18,2))) as total, count(*) as n from orders group by 1)
    select above as id, cast(coalesce(sum(total), 0) as double) as total, cast(coalesce(sum(n), 0) as bigint) as n_orders
    from pairs left join spent on id = below group by 1""",
)
def jn_15_totals_below(d):
    labels = interval_labels(_team(d), "id", "reports_to")
    spent = d.raw("orders").select(
        F.col("o_custkey").alias("id"), money("o_totalprice").alias("total"), F.lit(1).alias("n_orders")
    )
    return totals_below(labels, "id", spent, ["total", "n_orders"])


@check(
    "agg_03_count_column",
    f"""select o_custkey, count(*) as n, count(priority) as n_priority,
        {stamp('min(o_orderdate)')} as first_order, {stamp('max(o_orderdate)')} as last_order,
        {avg2('sum(cast(o_totalprice as decimal(18,2)))', 'count(o_totalprice)')} as avg_price
    from ({NULLED}) group by 1""",
)
def agg_03_count_column(d):
    return _nulled(d).groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.count("priority").alias("n_priority"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        average(F.sum(money("o_totalprice")), F.count("o_totalprice")).alias("avg_price"),
    )


@check(
    "agg_09_group_by_expression",
    """select l_partkey % 100 as bucket, count(*) as n, cast(max(l_quantity) as double) as max_quantity
    from lineitem group by 1""",
)
def agg_09_group_by_expression(d):
    grouped = d.raw("lineitem").groupBy((F.col("l_partkey") % 100).alias("bucket"))
    return grouped.agg(F.count("*").alias("n"), F.max("l_quantity").alias("max_quantity"))


@check(
    "agg_12_empty_sum",
    """select count(*) as n, cast(coalesce(sum(cast(o_totalprice as decimal(18,2))), 0) as double) as total
    from orders where o_totalprice < 0""",
)
def agg_12_empty_sum(d):
    none = d.raw("orders").filter("o_totalprice < 0")
    total = F.coalesce(F.sum(money("o_totalprice")), F.lit(0))
    return none.agg(F.count("*").alias("n"), total.alias("total"))


@check(
    "agg_14_distinct_ordered_list",
    """select l_suppkey, string_agg(distinct p_name, ', ' order by p_name) as products
    from lineitem join part on p_partkey = l_partkey group by 1""",
)
def agg_14_distinct_ordered_list(d):
    names = d.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    pairs = d.raw("lineitem").select("l_suppkey", "l_partkey").distinct().join(names, "l_partkey")
    return ordered_list(pairs, ["l_suppkey"], "p_name", distinct=True, name="products")


@check(
    "agg_13_ordered_list",
    """select o_custkey, string_agg(o_orderpriority, '|' order by o_orderpriority) as priorities
    from orders group by 1""",
)
def agg_13_ordered_list(d):
    return ordered_list(d.raw("orders"), ["o_custkey"], "o_orderpriority", "|", name="priorities")


@check(
    "agg_16_conditional_sum",
    """select l_suppkey, cast(sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end) as bigint)
        as returned, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
    from lineitem group by 1""",
)
def agg_16_conditional_sum(d):
    quantity = F.col("l_quantity").cast("bigint")
    returned = F.when(F.col("l_returnflag") == "R", quantity).otherwise(0)
    grouped = d.raw("lineitem").groupBy("l_suppkey")
    return grouped.agg(F.sum(returned).alias("returned"), F.sum(quantity).alias("quantity"))


@check(
    "agg_19_numeric_groups",
    """select (cast(p_size as bigint) // 10) * 10 as size_group, count(*) as n from part group by 1""",
)
def agg_19_numeric_groups(d):
    return d.raw("part").groupBy(bucket("p_size", 10).alias("size_group")).agg(F.count("*").alias("n"))


@check(
    "set_01_append",
    f"""select o_orderkey, {day('o_orderdate')} as o_orderdate from orders""",
)
def set_01_append(d):
    rows = d.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    old, new = rows.filter("o_orderdate < '1998-01-01'"), rows.filter("o_orderdate >= '1998-01-01'")
    return old.unionByName(new)


@check(
    "set_02_union_of_views",
    f"""select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by 1""",
)
def set_02_union_of_views(d):
    rows = d.raw("orders")

    def view(part):
        return part.groupBy("o_custkey").agg(
            F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("total")
        )

    early, late = rows.filter("o_orderdate < '1998-01-01'"), rows.filter("o_orderdate >= '1998-01-01'")
    both = view(early).unionByName(view(late))
    return both.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
