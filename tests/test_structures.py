"""Interval labels, curve layouts, load sketches and the segment topic, against plain Python."""

from __future__ import annotations

import bisect
import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.curve import curve_key, footers, touched, write_curve, write_ordered
from lakeloom.operators.intervals import interval_labels, rows_below, totals_below
from lakeloom.operators.profiles import describe, drift, frequent_values, merged, store_profile
from lakeloom.sources.segments import SCHEMA, SegmentReader, append_segments, read_segments
from lakeloom.streaming.jobs import append_rows, drain

# --- interval labels ---------------------------------------------------------------


def forest():
    """Bushy and deep trees, a parent with most of the rows, orphans, cycles and what hangs on them."""
    up = {i: None if i == 0 else (i - 1) // 3 for i in range(60)}
    up |= {100 + i: 99 + i if i else None for i in range(40)}
    up |= {1000 + i: 2 for i in range(150)}
    up |= {500: 501, 501: 500, 502: 500, 503: 503, 600: 999, 601: 600, 700: None}
    return up


def chain(up, key):
    """The rows above a key; None in or below a cycle."""
    found = []
    while up[key] in up:
        key = up[key]
        if key in found or len(found) > len(up):
            return None
        found.append(key)
    return found


def test_labels_pairs_and_totals_of_a_forest(spark):
    up = forest()
    rng = random.Random(3)
    shuffled = rng.sample(sorted(up.items()), len(up))
    rows = [*shuffled, shuffled[0], (None, 1)]
    labels = interval_labels(spark.createDataFrame(rows, "id int, up int"), "id", "up")
    got = {r.id: r for r in labels.collect()}
    chains = {k: chain(up, k) for k in up}
    assert got.keys() == up.keys()
    for key, above in chains.items():
        row = got[key]
        if above is None:
            assert (row.root, row.depth, row.low, row.high, row.n_below) == (None,) * 5
        else:
            n_below = sum(key in (c or []) for c in chains.values())
            assert (row.root, row.depth, row.n_below) == ([key, *above][-1], len(above), n_below)
    want = {(a, k) for k, above in chains.items() for a in above or []}
    inside = {
        (a.id, b.id) for a in got.values() for b in got.values()
        if a.root is not None and a.root == b.root and a.low < b.high < a.high
    }
    assert inside == want
    pairs = rows_below(labels, "id", labels.select("id")).collect()
    assert len(pairs) == len(want) and {(p.above, p.below) for p in pairs} == want
    value = {k: rng.randint(-50, 50) for k in up if k % 3}
    paid = spark.createDataFrame([(k, v) for k, v in value.items()] + [(100, 7), (None, 5), (12345, 3)], "id int, v int")
    value[100] = value.get(100, 0) + 7
    totals = {r.id: r.v for r in totals_below(labels, "id", paid, ["v"]).collect()}
    ones = {k: value.get(k, 0) + sum(value.get(b, 0) for a, b in want if a == k) for k in up if chains[k] is not None}
    assert totals == ones


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 1)], [(None, None)]])
def test_labels_of_tiny_tables(spark, rows):
    labels = interval_labels(spark.createDataFrame(rows, "id int, up int"), "id", "up")
    got = [(r.id, r.root, r.depth, r.n_below) for r in labels.collect()]
    assert got == [(1, 1, 0, 0)] * (rows == [(1, None)]) + [(1, None, None, None)] * (rows == [(1, 1)])
    assert rows_below(labels, "id", labels.select("id")).collect() == []
    paid = spark.createDataFrame([(1, 5)], "id int, v int")
    want = [(1, 5)] if rows == [(1, None)] else []
    assert list(map(tuple, totals_below(labels, "id", paid, ["v"]).collect())) == want


# --- curve layouts -----------------------------------------------------------------


def boxed(spark, n=20_000):
    """Rows of three columns; one customer has a third of them, some values are missing."""
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id", F.lit(1)) % 500)
    day = F.expr("timestampadd(HOUR, cast(pmod(xxhash64(id, 2), 9000) as int), timestamp_ntz '2024-01-01 00:00:00')")
    return spark.range(n).select(
        "id",
        hot.alias("customer"),
        F.when(F.col("id") % 50 > 0, F.expr("cast(pmod(xxhash64(id, 3), 40) as int)")).alias("store"),
        day.alias("day"),
    )


def test_curve_files_are_boxes_and_footers_never_exclude_a_match(spark, folder):
    rows = boxed(spark)
    write_curve(rows, f"{folder}/curve", ["day", "store", "customer"], 64)
    write_ordered(rows, f"{folder}/plain", ["day"], 64)
    day = dt.datetime(2024, 6, 1, 5)
    probes = {
        "day": {"day": (day, day + dt.timedelta(days=3))},
        "store": {"store": (3, 3)},
        "customer": {"customer": (-100, -98)},
        "both": {"store": (3, 3), "customer": (-100, -98)},
        "none": {"store": (100, None)},
    }
    filters = {
        "day": F.col("day").between(day, day + dt.timedelta(days=3)),
        "store": F.col("store") == 3,
        "customer": F.col("customer").between(-100, -98),
        "both": (F.col("store") == 3) & F.col("customer").between(-100, -98),
        "none": F.col("store") >= 100,
    }
    found = {}
    for name in ("curve", "plain"):
        stored = spark.read.parquet(f"{folder}/{name}")
        assert stored.exceptAll(rows).count() == rows.exceptAll(stored).count() == 0
        sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
        assert max(sizes) < 3 * 20_000 / 64
        groups = footers(spark, f"{folder}/{name}", probes).collect()
        for probe, condition in filters.items():
            hit = {r.file for r in groups if r.probe == probe and r.touched}
            held = {r[0] for r in stored.filter(condition).select("_metadata.file_path").distinct().collect()}
            assert held <= hit
        found[name] = {r.probe: r for r in touched(spark, f"{folder}/{name}", probes).collect()}
    for probe in ("day", "store", "customer", "both"):
        row = found["curve"][probe]
        assert row.n_rows == 20_000 and row.files_touched <= row.files / 2, probe
    assert found["curve"]["none"].files_touched == 0
    assert found["plain"]["day"].files_touched <= 3
    assert found["plain"]["store"].files_touched == found["plain"]["store"].files
    assert found["curve"]["both"].files_touched < found["curve"]["store"].files_touched


def test_row_groups_of_a_file_are_counted(spark, folder):
    rows = boxed(spark, 40_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    write_curve(rows, f"{folder}/groups", ["store", "customer"], 2, group_bytes=300_000)
    row = touched(spark, f"{folder}/groups", {"store": {"store": (3, 3)}}).first()
    assert row.files == 2 and row.row_groups > 8
    assert row.row_groups_touched < row.row_groups / 2 and row.rows_touched < 20_000


def test_curve_of_empty_columns_and_tables(spark, folder):
    rows = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    write_curve(rows, f"{folder}/nulls", ["a", "b"], 2)
    assert sorted(r.a for r in spark.read.parquet(f"{folder}/nulls").collect()) == [1, 2]
    assert touched(spark, f"{folder}/nulls", {"b": {"b": (0.0, None)}}).first().rows_touched == 0
    write_curve(rows.limit(0), f"{folder}/none", ["a", "b"], 2)
    assert spark.read.parquet(f"{folder}/none").count() == 0
    assert touched(spark, f"{folder}/none", {"b": {"b": (0.0, None)}}).collect() == []
    with pytest.raises(ValueError, match="62 bits"):
        curve_key(rows, ["a", "b"], bits=32)


# --- profiles of loads -------------------------------------------------------------


def loads(spark):
    """Three loads; the last one has other prices, another mix of kinds and more NULLs."""
    rng = random.Random(5)
    rows = []
    for load in range(3):
        for i in range(3000):
            price = None if rng.random() < (0.05, 0.05, 0.4)[load] else round(rng.gauss(100 + 60 * (load == 2), 20), 2)
            kind = rng.choice(("abcd", "abcd", "aaax")[load])
            rows.append((load, i + 3000 * load, price, kind, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(9000))))
    return rows, spark.createDataFrame(rows, "load int, id bigint, price double, kind string, at timestamp_ntz")


COLUMNS = ["id", "price", "kind", "at"]


def test_merged_profiles_match_the_rows(spark, folder):
    rows, df = loads(spark)
    for load in (0, 1, 2, 1):  # one is repeated
        store_profile(df.filter(F.col("load") == load), folder, load, COLUMNS)
    for chosen in ([0, 1, 2], [1]):
        kept = [r for r in rows if r[0] in chosen]
        got = {r["column"]: r for r in describe(merged(spark, folder, chosen)).collect()}
        for i, name in enumerate(COLUMNS, 1):
            values = sorted(r[i] for r in kept if r[i] is not None)
            row = got[name]
            assert (row.n_rows, row.nulls) == (len(kept), len(kept) - len(values))
            assert abs(row.n_distinct - len(set(values))) <= 0.05 * len(set(values))
            if name == "kind":
                assert (row.lowest, row.highest, row.quantiles) == (values[0], values[-1], None)
                continue
            number = [v.replace(tzinfo=dt.timezone.utc).timestamp() if name == "at" else float(v) for v in values]
            assert (float(row.lowest), float(row.highest)) == (number[0], number[-1])
            for share, found in zip((0.25, 0.5, 0.75), row.quantiles):
                below = sum(v <= found for v in number) / len(number)
                assert abs(below - share) < 0.015
        kinds = {r.value: r.n for r in frequent_values(merged(spark, folder, chosen), 10).filter("column = 'kind'").collect()}
        assert kinds == Counter(r[3] for r in kept)


def test_drift_between_loads(spark, folder):
    rows, df = loads(spark)
    for load in range(3):
        store_profile(df.filter(F.col("load") == load), folder, load, COLUMNS)
    alike = drift(merged(spark, folder, [0]), merged(spark, folder, [1])).collect()
    assert {r["column"]: r.drifted for r in alike} == {"id": True, "price": False, "kind": False, "at": False}
    found = {r["column"]: r for r in drift(merged(spark, folder, [0, 1]), merged(spark, folder, [2])).collect()}
    assert {c: r.drifted for c, r in found.items()} == {"id": True, "price": True, "kind": True, "at": False}
    old, new = ([r for r in rows if (r[0] == 2) == late] for late in (False, True))
    shares = [{k: n / len(side) for k, n in Counter(r[3] for r in side).items()} for side in (old, new)]
    half = sum(abs(shares[0].get(k, 0) - shares[1].get(k, 0)) for k in "abcdx") / 2
    assert abs(found["kind"].distance - half) < 1e-9
    prices = [sorted(r[2] for r in side if r[2] is not None) for side in (old, new)]
    points = sorted({*prices[0], *prices[1]})
    exact = max(abs(bisect.bisect(prices[0], p) / len(prices[0]) - bisect.bisect(prices[1], p) / len(prices[1])) for p in points)
    assert abs(found["price"].distance - exact) < 0.02
    nulls = [sum(r[2] is None for r in side) / len(side) for side in (old, new)]
    assert abs(found["price"].null_change - abs(nulls[0] - nulls[1])) < 1e-12


def test_profiles_of_empty_loads_and_columns_without_values(spark, folder):
    rows = spark.createDataFrame([(None, None, float("nan")), (None, None, 2.0)], "a int, b string, c double")
    store_profile(rows, folder, 1, ["a", "b", "c"])
    store_profile(rows.limit(0), folder, 2, ["a", "b", "c"])
    got = {r["column"]: r for r in describe(merged(spark, folder)).collect()}
    assert (got["a"].n_rows, got["a"].nulls, got["a"].n_distinct, got["a"].lowest, got["a"].quantiles) == (2, 2, 0, None, None)
    assert (got["b"].nulls, got["b"].highest) == (2, None)
    assert (got["c"].nulls, float(got["c"].highest)) == (0, 2.0)
    assert {r["column"] for r in frequent_values(merged(spark, folder), 5).collect()} == {"c"}
    same = drift(merged(spark, folder, [1]), merged(spark, folder, [2])).collect()
    assert {r["column"]: r.distance for r in same} == {"a": 0.0, "b": 0.0, "c": 1.0}


# --- segment topic -----------------------------------------------------------------


def records(spark, ids):
    rows = [(f"shop.public.t{i % 2}", str(i % 7), f"value {i}\nof", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=i, microseconds=i)) for i in ids]
    return spark.createDataFrame(rows, "topic string, key string, value string, ts timestamp")


def taken(spark, topic, place, **options):
    """Drain the topic into ``place``; the rows that are there then, and the batches."""
    drain(append_rows(read_segments(spark, topic, **options), f"{place}/data", f"{place}/checkpoint"))
    return sorted(spark.read.schema(SCHEMA).parquet(f"{place}/data").collect(), key=lambda r: (r.partition, r.segment, r.line))


def test_a_topic_is_read_once_in_order_and_replayed_alike(spark, folder):
    topic = f"{folder}/topic"
    append_segments(records(spark, range(50)), topic, "key", 3, 0)
    first = taken(spark, topic, f"{folder}/a", segments_per_task=2)
    assert sorted(map(tuple, (r[4:] for r in first))) == sorted(tuple(r[1:]) for r in records(spark, range(50)).collect())
    for segment in (1, 2, 3):
        append_segments(records(spark, range(50 * segment, 50 * segment + 50)), topic, "key", 3, segment)
    append_segments(records(spark, range(100, 150)), topic, "key", 3, 2)  # again: replaces itself
    later = taken(spark, topic, f"{folder}/a", segments_per_task=2)
    assert later == taken(spark, topic, f"{folder}/a") == taken(spark, topic, f"{folder}/b", segments_per_task=1)
    assert len(later) == 200 and set(first) <= set(later)
    for key in map(str, range(7)):
        mine = [r for r in later if r.key == key]
        assert len({r.partition for r in mine}) == 1 and [r.ts for r in mine] == sorted(r.ts for r in mine)


def test_a_gap_waits_and_late_readers_may_start_at_the_end(spark, folder):
    topic = f"{folder}/topic"
    for segment in (0, 2):
        append_segments(records(spark, range(10 * segment, 10 * segment + 10)), topic, "key", 2, segment)
    Path(f"{topic}/partition=0/x.draft").write_text("half a")
    assert len(taken(spark, topic, f"{folder}/a")) == 10
    assert taken(spark, topic, f"{folder}/late", starting_offsets="latest") == []
    append_segments(records(spark, range(10, 20)), topic, "key", 2, 1)
    assert len(taken(spark, topic, f"{folder}/a")) == 30
    assert {r.segment for r in taken(spark, topic, f"{folder}/late", starting_offsets="latest")} == {1, 2}
    with pytest.raises(ValueError, match="starting offsets"):
        read_segments(spark, topic, starting_offsets="middle")


def test_an_empty_topic_and_records_without_values(spark, folder):
    topic = f"{folder}/topic"
    assert taken(spark, topic, f"{folder}/a") == []
    rows = spark.createDataFrame([(None, None, None, None), ("t", "", "", None)], "topic string, key string, value string, ts timestamp")
    append_segments(rows.limit(0), topic, "key", 2, 0)
    append_segments(rows, topic, "key", 2, 1)
    got = taken(spark, topic, f"{folder}/a")
    assert sorted([tuple(r[4:]) for r in got], key=str) == [("", "", None), (None, None, None)]


def test_a_lost_segment_of_a_planned_range_fails(folder):
    reader = SegmentReader({"path": str(folder), "segmentsPerTask": "2"})
    ranges = [p.value for p in reader.partitions({"0": 1}, {"0": 4, "1": 1})]
    assert ranges == [(0, 1, 3), (0, 3, 4), (1, 0, 1)]
    with pytest.raises(FileNotFoundError):
        list(reader.read(reader.partitions({}, {"0": 1})[0]))
