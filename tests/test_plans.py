"""What the optimizer makes of the queries."""

from __future__ import annotations

import pytest

from lakeloom.checks import REGISTRY
from lakeloom.functions.money import money
from lakeloom.plans import marts, reports
from lakeloom.plans.binding import Domain
from lakeloom.sources.relational import FolderSource, import_table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, FOLDER)


def test_import_filter_and_columns_reach_the_scan(spark):
    df = import_table(spark, FolderSource(FOLDER), "customer", "c_acctbal > 5000", ["c_custkey"])
    text = plan(df)
    assert "GreaterThan(c_acctbal,5000.0)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in text


def test_monthly_revenue_reads_only_its_columns(domain):
    text = plan(marts.monthly_revenue(domain.payment(), domain.rental_line(), domain.film(), unique=True))
    for columns in ("struct<l_orderkey:bigint,l_partkey:bigint>",
                    "struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>",
                    "struct<p_partkey:bigint,p_brand:string>"):
        assert f"ReadSchema: {columns}" in text


def test_dates_reach_the_scan(domain):
    good = reports.rewards(domain.customer(), domain.payment(), "1998-05-17", 1, 1)
    assert "GreaterThanOrEqual(o_orderdate,1998-04-01" in plan(good)
    owed = reports.balances(domain.customer(), domain.rental(), domain.film(), domain.payment(), "1998-06-30")
    assert "LessThanOrEqual(o_orderdate,1998-06-30" in plan(owed)


def test_unique_payments_save_a_shuffle(spark, domain):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = (domain.payment(), domain.rental_line(), domain.film())
        few = plan(marts.monthly_revenue(*args, unique=True)).count("hashpartitioning(rental_id")
        many = plan(marts.monthly_revenue(*args)).count("hashpartitioning(rental_id")
        assert few < many
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cleaning_filters_before_the_shuffle(domain):
    from lakeloom.operators.quality import clean, default_rules

    rows = domain.raw("orders").selectExpr("o_orderkey as payment_id", "o_totalprice", "o_orderdate as last_update")
    text = plan(clean(rows.withColumn("amount", money("o_totalprice")).drop("o_totalprice"),
                      default_rules()["payment"])).split("== Physical Plan ==")[1]
    assert text.index("Exchange") < text.index("Filter")  # the filter is below the exchange


@pytest.mark.parametrize("name", [
    "monthly_revenue", "customer_lifetime_value", "film_performance", "store_performance", "film_list",
    "actor_info", "sales_by_store", "items_in_stock", "item_holder", "customer_balance", "jn_15_manager",
    "federated_metrics", "inc_03_merge", "orphans", "win_03_rank_with_ties", "win_04_cumulative_share"])
def test_no_cross_join_and_no_single_task_sort(spark, name):
    text = plan(REGISTRY[name].run(spark, FOLDER)).split("== Physical Plan ==")[1]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Window [", "Exchange SinglePartition"):
        if bad == "Window [" and name.startswith(("win_", "customer_lifetime", "film_performance")):
            continue  # ranges are ranked in windows with a partition key
        if bad == "Exchange SinglePartition" and name == "orphans":
            continue  # one row of totals
        assert bad not in text, bad


@pytest.fixture
def no_broadcasts(spark):
    """Plans as they are when no side is small."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def exchanges(df) -> int:
    return plan(df).split("== Physical Plan ==")[1].split("== Initial")[0].count("Exchange hashpartitioning")


@pytest.mark.parametrize(("name", "most"), [
    ("film_list", 6), ("actor_info", 8), ("item_holder", 5), ("flt_05_open_rentals", 2),
    ("film_search", 0), ("agg_13_ordered_list", 1), ("agg_14_distinct_ordered_list", 4), ("monthly_revenue", 6)])
def test_number_of_shuffles(spark, no_broadcasts, name, most):
    assert exchanges(REGISTRY[name].run(spark, FOLDER)) <= most


def test_open_rentals_are_filtered_before_the_join(domain, no_broadcasts):
    tree = domain.rental(only_open=True)._jdf.queryExecution().executedPlan().toString()
    join, condition = tree.index("Join"), tree.index("Filter (CASE WHEN NOT (l_linestatus")
    assert condition > join  # the tree is printed from the top


def test_small_delta_does_not_shuffle_the_table(spark, folder):
    from lakeloom.operators.incremental import VersionedTable

    table = VersionedTable(spark, folder, ("k",), ("t",))
    table.add(spark.range(20_000).selectExpr("id as k", "1 as t", "uuid() as x"))
    table.add(spark.range(3).selectExpr("id as k", "2 as t", "'new' as x"))
    df = table.read()
    assert len(df.collect()) == 20_000
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [line for line in final.splitlines() if "LeftAnti" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
