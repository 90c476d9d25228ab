"""Equivalences with brute force on random tables."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.functions.money import rounded_ratio
from lakeloom.operators import incremental as inc
from lakeloom.operators.quality import clean, default_rules, quality_report, split_valid
from lakeloom.operators.ranking import cumulative_share, global_rank, latest_by_key, pareto
from lakeloom.operators.relational import hierarchy


def amounts(spark, seed, n=800, hot=False):
    pick = random.Random(seed)
    values = [None if pick.random() < 0.05 else Decimal(pick.randrange(1, 20000)) / 100 for _ in range(n)]
    if hot:  # a third of the rows share one value
        values = [Decimal("50.00") if i % 3 == 0 else v for i, v in enumerate(values)]
    return spark.createDataFrame(list(enumerate(values)), "id bigint, v decimal(18,2)")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_equals_window(spark, hot, descending):
    df = amounts(spark, 3, hot=hot)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    window = Window.orderBy(order)
    ahead = F.rank().over(window) - 1
    want = df.select("id", F.dense_rank().over(window).alias("r"),
                     rounded_ratio(ahead * 100, F.lit(df.count() - 1)).alias("p"))
    got = global_rank(df, "v", dense="r", percentile="p", descending=descending).select("id", "r", "p")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_global_rank_plan_has_no_single_task_window(spark):
    found = global_rank(amounts(spark, 1), "v", percentile="p")
    assert "SinglePartition" not in found._jdf.queryExecution().toString()


def test_rank_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, Decimal("2.00"))], "id int, v decimal(18,2)")
    assert global_rank(one, "v", percentile="p").first()["p"] == 0
    assert global_rank(one.limit(0), "v", percentile="p").count() == 0


def test_running_total_equals_window(spark):
    df = amounts(spark, 5, hot=True).dropna()
    want = df.select("id", F.sum("v").over(Window.orderBy(F.desc("v"))).cast("decimal(20,2)"))
    got = cumulative_share(df, "v").select("id", F.col("running_total").cast("decimal(20,2)"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("hot", [False, True])
def test_pareto_equals_brute_force(spark, hot):
    df = amounts(spark, 8, hot=hot)
    values = sorted((r.v for r in df.collect() if r.v is not None), reverse=True)
    total, head, running, needed = sum(values), -(-len(values) // 100), Decimal(0), 0
    for needed, v in enumerate(values, 1):
        running += v
        if running * 100 >= total * 80:
            break
    got = pareto(df, "v").first()
    assert (got.n_rows, got.head_rows, got.head_total, got.rows_for_target) == (
        len(values), head, sum(values[:head]), needed)


def test_latest_by_key_with_a_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i % 50, i * 37 % 101, i) for i in range(3000)]
    got = latest_by_key(spark.createDataFrame(rows, "k int, t int, x int"), ["k"], ["t"]).collect()
    want = {}
    for k, t, x in rows:
        want[k] = max(want.get(k, (-1, -1)), (t, x))
    assert {r.k: (r.t, r.x) for r in got} == want


def changes(spark, seed, n=300):
    pick = random.Random(seed)
    rows = [(pick.randrange(40), i, pick.choice("IUD"), pick.randrange(1000)) for i in range(n)]
    return spark.createDataFrame(rows, "k int, t int, op string, x int"), rows


def test_merge_does_not_depend_on_the_split(spark, folder):
    delta, rows = changes(spark, 4)
    want = {}
    for k, t, op, x in rows:
        want[k] = (op, t, x)
    want = {k: (t, x) for k, (op, t, x) in want.items() if op != "D"}
    for cuts in ([150], [10, 20, 290], []):
        table = inc.VersionedTable(spark, f"{folder}/{len(cuts)}", ("k",), ("t",))
        edges = [0, *cuts, 300]
        for low, high in zip(edges, edges[1:]):
            part = delta.filter((F.col("t") >= low) & (F.col("t") < high))
            table.add(part)
            table.add(part)  # repeated delivery
        assert {r.k: (r.t, r.x) for r in table.read().collect()} == want
        table.compact()
        assert {r.k: (r.t, r.x) for r in table.read().collect()} == want


def test_uncommitted_folder_is_ignored(spark, folder):
    table = inc.VersionedTable(spark, folder, ("k",), ("t",))
    first = spark.createDataFrame([(1, 1, 5)], "k int, t int, x int")
    table.add(first)
    path = f"{folder}/base-2"
    first.withColumn("x", F.lit(9)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert [r.x for r in table.read().collect()] == [5]


def dirty_payments(spark):
    pick = random.Random(2)
    rows = [
        (pick.choice([None, *range(60)]), pick.choice([None, Decimal("-1.00"), Decimal("0.00"), Decimal("3.50")]), i)
        for i in range(500)
    ]
    return spark.createDataFrame(rows, "payment_id bigint, amount decimal(18,2), last_update int")


def test_accepted_and_rejected_make_the_input(spark):
    df, rules = dirty_payments(spark), default_rules()["payment"]
    accepted, rejected = split_valid(df, rules)
    assert accepted.count() + rejected.count() == 500
    report = quality_report(df, rules, "payment").first()
    cleaned = clean(df, rules)
    assert (report.rows_in, report.rows_out) == (500, cleaned.count())
    assert report.rows_dropped == 500 - cleaned.count()
    assert cleaned.join(df, ["payment_id", "amount", "last_update"], "left_anti").count() == 0
    assert cleaned.select("payment_id").distinct().count() == cleaned.count()


def test_hierarchy_depth(spark):
    rows = [(i, None if i == 0 else (i - 1) // 3) for i in range(200)] + [(500, 501), (501, 500)]
    rows += [(600, 999), (601, 600), (602, 601), (700, 500), (800, 800)]
    rows += [(1000 + i, 999 + i if i else None) for i in range(300)]
    found = hierarchy(spark.createDataFrame(rows, "id int, up int"), "id", "up").collect()

    def depth(i):
        return 0 if i == 0 else 1 + depth((i - 1) // 3)

    want = {i: (depth(i), "reached") for i in range(200)}
    want |= {i: (None, "cycle") for i in (500, 501, 700, 800)}
    want |= {i: (None, "orphan") for i in (600, 601, 602)}
    want |= {1000 + i: (i, "reached") for i in range(300)}
    assert len(found) == len(rows)
    assert {r.id: (r.depth, r.state) for r in found} == want


def test_rounding_is_half_up_and_exact(spark):
    rows = [(Decimal("1.01"), 2), (Decimal("-1.01"), 2), (Decimal("0.03"), 2), (Decimal("10.00"), 3), (None, 1),
            (Decimal("1.00"), 0)]
    df = spark.createDataFrame(rows, "s decimal(18,2), n bigint")
    got = [r[0] for r in df.select(rounded_ratio(F.col("s"), F.col("n"))).collect()]
    assert [None if v is None else str(v) for v in got] == ["0.51", "-0.51", "0.02", "3.33", None, None]


def test_area_under_curve_equals_brute_force(spark):
    from lakeloom.plans.explore import area_under_curve

    pick = random.Random(6)
    rows = [(float(pick.randrange(20)) / 20, float(pick.random() < 0.4)) for _ in range(300)]
    won = sum((a > b) + (a == b) / 2 for a, x in rows if x for b, y in rows if not y)
    pairs = sum(1 for _, x in rows if x) * sum(1 for _, x in rows if not x)
    df = spark.createDataFrame(rows, "s double, y double")
    assert area_under_curve(df, "s", "y").first().auc == pytest.approx(won / pairs)
    assert area_under_curve(df.filter("y = 1"), "s", "y").first().auc is None


def test_model_judges_cases_with_missing_numbers(spark):
    from lakeloom.plans.explore import outcome_model, split_cases

    pick = random.Random(2)
    rows = [(i, None if i % 3 else float(i % 7), pick.choice(["a", "b", None]), pick.choice([0, 1, 1, None]))
            for i in range(600)]
    cases = spark.createDataFrame(rows, "id bigint, x double, c string, y int")
    _, test = split_cases(cases.filter("y is not null"), "id")
    report = outcome_model(cases, "id", ["x"], ["c"], "y", iterations=5).first()
    assert report.n_test == test.count()
    assert report.n_without_outcome == sum(r[3] is None for r in rows)
