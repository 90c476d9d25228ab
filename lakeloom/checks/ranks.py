"""Ranking, deduplication and running totals."""

from lakeloom.checks.registry import check, having, ratio, stamp
from lakeloom.operators.ranking import (
    cumulative_share,
    global_rank,
    latest_by_key,
    most_frequent,
    pareto,
    top_rows,
)
from pyspark.sql import functions as F

LINE = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
SPENT = "spent as (select customer_id, sum(amount) as total_spent from payment group by 1)\n"


def _spent(d):
    return d.payment().groupBy("customer_id").agg(F.sum("amount").alias("total_spent"))


@check(
    "win_01_dense_rank",
    having("payment") + ", " + SPENT
    + """select customer_id, cast(total_spent as double) as total_spent,
        dense_rank() over (order by total_spent desc nulls last) as spend_rank from spent""",
)
def win_01_dense_rank(d):
    return global_rank(_spent(d), "total_spent", dense="spend_rank")


@check(
    "win_02_percent_rank",
    having("payment") + ", " + SPENT
    + f"""select customer_id, {ratio('ahead * 100', 'others')} as percentile
    from (select customer_id, rank() over (order by total_spent desc nulls last) - 1 as ahead,
                 count(*) over () - 1 as others from spent)""",
)
def win_02_percent_rank(d):
    ranked = global_rank(_spent(d), "total_spent", dense=None, percentile="percentile")
    return ranked.select("customer_id", "percentile")


# Ties and NULLs: spending in thousands, NULL from two million on.
@check(
    "win_03_rank_with_ties",
    having("payment")
    + f""", coarse as (
        select customer_id, cast(floor(sum(amount) / 1000) as bigint) as k from payment group by 1),
    valued as (select customer_id, case when k < 2000 then k end as k from coarse)
    select customer_id, k, r as rank_asc, {ratio('ahead * 100', 'others')} as percentile
    from (select customer_id, k, dense_rank() over (order by k nulls last) as r,
                 rank() over (order by k nulls last) - 1 as ahead, count(*) over () - 1 as others
          from valued)""",
)
def win_03_rank_with_ties(d):
    coarse = (
        d.payment()
        .groupBy("customer_id")
        .agg(F.floor(F.sum("amount") / 1000).cast("bigint").alias("k"))
        .withColumn("k", F.when(F.col("k") < 2000, F.col("k")))
    )
    return global_rank(coarse, "k", dense="rank_asc", percentile="percentile", descending=False)


@check(
    "win_04_cumulative_share",
    having("payment") + ", " + SPENT
    + f"""select customer_id, cast(total_spent as double) as total_spent,
        cast(running as double) as running_total,
        {ratio('(running * 10000)', 'cast(total * 100 as hugeint)')} as share_pct
    from (select *, sum(total_spent) over (order by total_spent desc) as running,
                 sum(total_spent) over () as total from spent)""",
)
def win_04_cumulative_share(d):
    return cumulative_share(_spent(d), "total_spent")


@check(
    "win_05_latest_row",
    f"""select o_custkey, o_orderkey, {stamp('o_orderdate')} as o_orderdate from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def win_05_latest_row(d):
    rows = d.raw("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_by_key(rows, ["o_custkey"], ["o_orderdate"])


@check(
    "pareto_customers",
    having("payment") + ", " + SPENT
    + f""", ordered as (
        select total_spent, row_number() over w as rn, sum(total_spent) over (w rows unbounded preceding) as running,
               sum(total_spent) over () as total, count(*) over () as n
        from spent window w as (order by total_spent desc, customer_id)),
    facts as (
        select max(n) as n_rows, cast(ceil(max(n) / 100.0) as bigint) as head_rows, max(total) as total,
               sum(total_spent) filter (where rn <= ceil(n / 100.0)) as head_total,
               min(rn) filter (where running * 100 >= total * 80) as rows_for_target
        from ordered)
    select n_rows, head_rows, cast(head_total as double) as head_total,
           {ratio('(head_total * 10000)', 'cast(total * 100 as hugeint)')} as head_share_pct,
           rows_for_target, {ratio('rows_for_target * 100', 'n_rows')} as rows_for_target_pct
    from facts""",
)
def pareto_customers(d):
    return pareto(_spent(d), "total_spent")


@check(
    "agg_20_deduplicate",
    f"""select {LINE.replace('l_linenumber', 'cast(l_linenumber as bigint) as l_linenumber')} from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,
        l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc,
        l_returnflag desc, l_linestatus desc) = 1""",
)
def agg_20_deduplicate(d):
    rows = d.raw("lineitem").select(*LINE.split(", "), "l_shipdate")
    return latest_by_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).drop("l_shipdate")


@check(
    "agg_17_most_frequent",
    """select o_custkey, o_orderpriority, n from (
        select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2)
    qualify row_number() over (partition by o_custkey order by n desc, o_orderpriority) = 1""",
)
def agg_17_most_frequent(d):
    return most_frequent(d.raw("orders"), ["o_custkey"], "o_orderpriority")


@check(
    "srt_04_top_orders",
    """select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20""",
)
def srt_04_top_orders(d):
    rows = d.raw("orders").select("o_orderkey", "o_totalprice")
    return top_rows(rows, [F.desc("o_totalprice"), F.col("o_orderkey")], 20)
