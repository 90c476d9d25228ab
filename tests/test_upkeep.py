"""Tables, views and indexes kept by batches, against doing everything anew."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cascade, keytree
from lakeloom.operators.textindex import TextIndex
from lakeloom.operators.views import Changing, ExtremesView, GroupedView, signed


# --- key trees ---------------------------------------------------------------------

SCHEMA = "a int, b string, x double, y string"


def rows_of(rng, n):
    return {(rng.choice([None, *range(n)]), rng.choice("pqr")): (rng.random(), rng.choice([None, "u", "v"])) for _ in range(n)}


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)


@pytest.mark.parametrize("leaf_rows", [7, 100_000])
def test_changes_match_a_comparison_of_all_rows(spark, folder, leaf_rows):
    rng = random.Random(leaf_rows)
    old = rows_of(rng, 300)
    new = dict(old)
    for k in rng.sample(sorted(old, key=repr), 20):
        del new[k]
    for k in rng.sample(sorted(new, key=repr), 20):
        new[k] = (new[k][0], "w")
    new |= {(1000 + i, "n"): (0.5, None) for i in range(20)}
    before = keytree.take_state(frame(spark, old), ["a", "b"], f"{folder}/old", leaf_rows=leaf_rows)
    after = keytree.take_state(frame(spark, new), ["a", "b"], f"{folder}/new", like=before)
    want = {(k, "deleted") for k in old.keys() - new.keys()}
    want |= {(k, "inserted") for k in new.keys() - old.keys()}
    want |= {(k, "changed") for k in old.keys() & new.keys() if old[k] != new[k]}
    got = keytree.changes(before, after, ["a", "b"]).collect()
    assert len(got) == len(want) and {((r.a, r.b), r.change) for r in got} == want
    assert keytree.changes(before, before, ["a", "b"]).collect() == []


def test_only_leaves_that_differ_are_read(spark, folder):
    rows = spark.range(20_000).selectExpr("id as k", "id * 2 as x")
    before = keytree.take_state(rows, ["k"], f"{folder}/old", leaf_rows=200)
    edited = rows.withColumn("x", F.when(F.col("k").isin(5, 12_345), -1).otherwise(F.col("x")))
    after = keytree.take_state(edited.filter("k <> 19999"), ["k"], f"{folder}/new", like=before)
    leaves = keytree.differing_leaves(before, after)
    assert len(leaves) == 3
    assert before.nodes().filter("level = 2").count() > 60
    found = keytree.changes(before, after, ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[_leaf#\d+ IN \(([\d,]+)\)", plan)
    assert len(pruned) == 2 and all(sorted(map(int, p.split(","))) == leaves for p in pruned)
    assert sorted(map(tuple, found.collect())) == [(5, "changed"), (12345, "changed"), (19999, "deleted")]
    sizes = [r["count"] for r in before.rows().groupBy("_leaf").count().collect()]
    assert max(sizes) < 3 * 200


def test_states_of_empty_tables_and_repeated_keys(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "k int, x string")
    empty = keytree.take_state(rows.limit(0), ["k"], f"{folder}/none")
    full = keytree.take_state(rows, ["k"], f"{folder}/full", like=empty)
    fewer = keytree.take_state(rows.filter("x <> 'b'"), ["k"], f"{folder}/fewer", like=empty)
    assert sorted(map(tuple, keytree.changes(empty, full, ["k"]).collect())) == [(1, "inserted"), (2, "inserted")]
    assert list(map(tuple, keytree.changes(full, fewer, ["k"]).collect())) == [(1, "changed")]
    other = keytree.take_state(rows, ["k"], f"{folder}/other", leaf_rows=1)
    with pytest.raises(ValueError, match="key ranges"):
        keytree.changes(full, other, ["k"])


# --- maintained views --------------------------------------------------------------


def test_views_equal_a_full_computation_after_every_batch(spark, folder):
    rng = random.Random(4)
    left_schema, right_schema = "id int, k int, month int, amount decimal(10,2)", "k int, kind string"
    left, right, serial = {}, {k: "ab"[k % 2] for k in range(6)}, 0
    view = GroupedView(spark, f"{folder}/v", ("month", "kind"), {"total": "amount"}, {"n": "amount"}, ("month",))
    extremes = ExtremesView.of(spark, f"{folder}/e", "k", "amount")

    def frames(l, r):
        return (
            spark.createDataFrame([(i, *v) for i, v in l.items()], left_schema),
            spark.createDataFrame(list(r.items()), right_schema),
        )

    from decimal import Decimal

    for batch in range(1, 5):
        old_left, old_right = dict(left), dict(right)
        for _ in range(30):
            left[serial] = (rng.randrange(8), rng.randrange(1, 4), rng.choice([None, Decimal(rng.randrange(900)) / 100]))
            serial += 1
        for i in rng.sample(sorted(old_left), min(len(old_left), 12)):
            del left[i]
        if batch > 1:
            right[rng.randrange(6)] = "c"
        if batch == 4:
            left = {i: v for i, v in left.items() if v[1] != 2}  # a month loses all its rows
        before, after = frames(old_left, old_right), frames(left, right)
        came = [a.exceptAll(b) for a, b in zip(after, before)]
        went = [b.exceptAll(a) for a, b in zip(after, before)]
        if batch == 1:
            before = (before[0], after[1].limit(0))
            came[1], went[1] = after[1], after[1].limit(0)
        sides = [Changing(b, signed(c, w)) for b, c, w in zip(before, came, went)]
        joined = sides[0].join(sides[1], "k")
        for _ in range(2):  # the second time changes nothing
            view.apply(joined.change, batch)
            extremes.apply(sides[0].change, batch)
        want: dict = {}
        for k, month, amount in left.values():
            if k in right:
                line = want.setdefault((month, right[k]), [None, 0, 0])
                line[2] += 1
                if amount is not None:
                    line[0] = (line[0] or 0) + amount
                    line[1] += 1
        got = {(r.month, r.kind): [r.total, r.n, r["_rows"]] for r in view.read().collect()}
        assert got == want
        values: dict = {}
        for k, _, amount in left.values():
            if amount is not None:
                values.setdefault(k, []).append(amount)
        got = {r.k: (r.least, r.most) for r in extremes.read("least", "most").collect()}
        assert got == {k: (min(v), max(v)) for k, v in values.items()}


def test_only_touched_months_are_written(spark, folder):
    view = GroupedView(spark, f"{folder}/v", ("month", "g"), {"total": "x"}, {}, ("month",))
    rows = spark.range(1200).selectExpr("cast(id % 12 as int) as month", "id % 5 as g", "id as x")
    view.apply(signed(rows), 1)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in Path(folder, "v").rglob("*.parquet")}

    before = files()
    change = signed(rows.filter("month = 3 and x < 50"), rows.filter("month = 7 and x < 50"))
    assert sorted(view.apply(change, 2)) == [(3,), (7,)]
    changed = set(files().items()) ^ set(before.items())
    assert {re.search(r"month=(\d+)", f).group(1) for f, _ in changed} == {"3", "7"}
    assert view.apply(change, 2) == []
    plan = view._stored().filter(view._among({(3,), (7,)}))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan


# --- text index --------------------------------------------------------------------


def tokens(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def test_index_follows_changes(spark, folder):
    rng = random.Random(8)
    words = "red green blue tree house and the of Über x1".split()
    index = TextIndex(spark, folder, buckets=8)
    texts: dict[int, str] = {}
    for version in range(1, 5):
        changed = {i: " ".join(rng.choices(words, k=rng.randrange(0, 30))) + "," for i in rng.sample(range(60), 25)}
        gone = set(rng.sample(sorted(texts), 5)) - set(changed) if texts else set()
        texts = {i: t for i, t in (texts | changed).items() if i not in gone}
        rows = [(i, t, "U") for i, t in changed.items()] + [(i, None, "D") for i in gone]
        index.apply(spark.createDataFrame(rows, "i int, body string, op string"), "i", ["body"], version)
        if version == 3:
            index.compact()
        want: Counter = Counter()
        for i, t in texts.items():
            found = tokens(t)
            want[i] = sum(found[j : j + 3] == ["red", "the", "red"] for j in range(len(found)))
        got = {r.key: r.places for r in index.phrase("red THE red").collect()}
        assert got == {i: n for i, n in want.items() if n}
    lengths = {i: tokens(t) for i, t in texts.items()}
    mean = sum(map(len, lengths.values())) / len(lengths)
    scores = {}
    for term in ("red", "über"):
        holding = {i: t.count(term) for i, t in lengths.items() if term in t}
        rarity = math.log(1 + (len(lengths) - len(holding) + 0.5) / (len(holding) + 0.5))
        for i, tf in holding.items():
            size = 1.2 * (0.25 + 0.75 * len(lengths[i]) / mean)
            scores[i] = scores.get(i, 0) + rarity * tf * 2.2 / (tf + size)
    want = sorted((-round(s, 6), i) for i, s in scores.items())[:7]
    got = [(-r.score, r.key) for r in index.search("red ÜBER, absent", 7).collect()]
    assert got == want
    assert index.search("...").collect() == [] and index.phrase("").collect() == []


def test_a_query_reads_the_folders_of_its_terms(spark, folder):
    index = TextIndex(spark, folder, buckets=16)
    rows = [(i, f"word{i} word{i + 1}") for i in range(200)]
    index.apply(spark.createDataFrame(rows, "i int, body string"), "i", ["body"], 1)
    plan = index.postings(["word7"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan)
    assert sorted(r.key for r in index.postings(["word7"]).collect()) == [6, 7]


def test_postings_are_made_in_their_rows_and_shuffled_once(spark, folder, monkeypatch):
    index, plans, write = TextIndex(spark, folder, buckets=4), [], TextIndex._write

    def seen(self, postings, name):
        plans.append(postings._jdf.queryExecution().executedPlan().toString())
        write(self, postings, name)

    monkeypatch.setattr(TextIndex, "_write", seen)
    texts = {1: "b a b, B", 2: "", 3: "a " * 500, 4: "c", 5: None}

    def batch(rows):
        return spark.createDataFrame(list(rows), "i int, body string")

    def positions(*terms):
        return {(r.term, r.key): r.positions for r in index.postings(terms).collect()}

    index.apply(batch(texts.items()), "i", ["body"], 1)
    assert "Exchange" not in plans.pop()
    want = {("b", 1): [0, 2, 3], ("a", 1): [1], ("a", 3): list(range(500)), ("c", 4): [0]}
    assert positions("a", "b", "c") == want
    for _ in range(2):  # delivered again, with a key that comes twice
        index.apply(batch([(4, "d"), (6, "d e"), (6, "e d d")]), "i", ["body"], 2)
    plans.clear()
    index.compact()
    assert "hashpartitioning(term" not in plans.pop()
    del want["c", 4]
    want |= {("d", 4): [0], ("d", 6): [0, 1, 2], ("e", 6): [0, 1]}
    assert positions("a", "b", "c", "d", "e") == want
    assert spark.read.parquet(index._folders()[0]).count() == len(want)


# --- deletes over a graph ----------------------------------------------------------


def slow_delete(tables, keys, relations, table, doomed):
    """Rows (dicts) left per table and vetoed keys, one root at a time."""

    def key(t, row):
        return tuple(row[k] for k in keys[t])

    def children(t, k, rule):
        for r in relations:
            if r.parent == t and r.rule == rule:
                for row in tables[r.child]:
                    if tuple(row[c] for c in r.columns) == k:
                        yield r, row

    gone, vetoed = set(), set()
    for root in doomed:
        reached, front, held = {(table, root)}, [(table, root)], False
        while front:
            t, k = front.pop()
            held = held or any(True for _ in children(t, k, "restrict"))
            for r, row in children(t, k, "cascade"):
                node = (r.child, key(r.child, row))
                if node not in reached:
                    reached.add(node)
                    front.append(node)
        if held:
            vetoed.add(root)
        else:
            gone |= reached
    left = {}
    for t, rows in tables.items():
        left[t] = []
        for row in rows:
            if (t, key(t, row)) in gone:
                continue
            row = dict(row)
            for r in relations:
                if r.child == t and r.rule == "set_null" and (r.parent, tuple(row[c] for c in r.columns)) in gone:
                    row |= dict.fromkeys(r.columns)
            left[t].append(row)
    return left, vetoed


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deletes_follow_the_graph(spark, seed):
    rng = random.Random(seed)
    n = 40
    tables = {
        "node": [{"id": i, "up": rng.choice([None, *range(n)])} for i in range(n)],
        "leaf": [{"a": i % 7, "b": i // 7, "node": rng.choice([None, *range(n)]), "tag": rng.randrange(n)} for i in range(60)],
        "hold": [{"h": i, "a": rng.randrange(7), "b": rng.randrange(9)} for i in range(2)],
    }
    types = {"node": "id int, up int", "leaf": "a int, b int, node int, tag int", "hold": "h int, a int, b int"}
    keys = {"node": ("id",), "leaf": ("a", "b"), "hold": ("h",)}
    relations = [
        cascade.Relation("node", ("up",), "node", "cascade"),
        cascade.Relation("leaf", ("node",), "node", "cascade"),
        cascade.Relation("leaf", ("tag",), "node", "set_null"),
        cascade.Relation("hold", ("a", "b"), "leaf", "restrict"),
    ]
    frames = {t: spark.createDataFrame([tuple(r.values()) for r in rows], types[t]) for t, rows in tables.items()}
    doomed = rng.sample(range(n), 6)
    schema = cascade.Schema(frames, keys, relations)
    asked = spark.createDataFrame([(i,) for i in [*doomed, 999]], "id int")
    after = cascade.delete(schema, "node", asked)
    left, vetoed = slow_delete(tables, keys, relations, "node", [(i,) for i in doomed])
    for t, rows in left.items():
        got = sorted((tuple(r) for r in after.tables[t].collect()), key=repr)
        assert got == sorted((tuple(r.values()) for r in rows), key=repr)
    got = set() if after.vetoed is None else {tuple(r) for r in after.vetoed.collect()}
    assert got == vetoed


def test_cycles_end_and_unknown_rules_are_refused(spark):
    rows = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4), (5, 1)], "id int, up int")
    schema = cascade.Schema({"t": rows}, {"t": ("id",)}, [cascade.Relation("t", ("up",), "t", "cascade")])
    after = cascade.delete(schema, "t", rows.filter("id = 2"))
    assert [r.id for r in after.tables["t"].collect()] == [4]
    assert after.vetoed is None
    assert cascade.delete(schema, "t", rows.filter("id = 99")).tables["t"].count() == 5
    with pytest.raises(ValueError):
        cascade.Relation("t", ("up",), "t", "ignore")


# --- keys that are found -----------------------------------------------------------


def test_found_references_and_keys_match_brute_force(spark):
    from itertools import combinations

    from lakeloom.operators.discovery import inclusions, unique_sets

    rng = random.Random(12)
    rows = [(rng.randrange(12), rng.randrange(9), rng.choice("abc"), rng.choice([None, 1, 2])) for _ in range(40)]
    rows = list(dict.fromkeys(rows))
    other = [(i, str(i % 5), None) for i in range(12)]
    left = spark.createDataFrame(rows, "a int, b bigint, c string, d smallint")
    right = spark.createDataFrame(other, "x bigint, y string, z int")
    values = {("l", n): {r[i] for r in rows} - {None} for i, n in enumerate("abcd")}
    values |= {("r", n): {r[i] for r in other} - {None} for i, n in enumerate("xyz")}
    want = {
        (*p, *q, len(v)) for p, v in values.items() for q, w in values.items()
        if p != q and v and w and v <= w
    }
    got = {tuple(r) for r in inclusions({"l": left, "r": right}).collect()}
    assert got == want and len(want) > 2
    unique = [s for n in (1, 2, 3) for s in combinations(range(4), n) if len({tuple(r[i] for i in s) for r in rows}) == len(rows)]
    minimal = {"".join("abcd"[i] for i in s) for s in unique if not any(set(t) < set(s) for t in unique)}
    assert {"".join(r.columns) for r in unique_sets(left).collect()} == minimal
    assert {"".join(r.columns) for r in unique_sets(left.limit(0)).collect()} == set("abcd")
    doubled = unique_sets(left.unionByName(left))
    assert doubled.collect() == []


def test_found_keys_write_the_table_once_and_miss_no_slice(spark, monkeypatch):
    from lakeloom.operators import discovery

    written, store = [], discovery.materialize
    monkeypatch.setattr(discovery, "materialize", lambda df, label: written.append(label) or store(df, label))
    # In column j the value j comes twice, wherever its hash puts it; in `u` none does.
    names = [*(f"c{j}" for j in range(20)), "u"]
    rows = [tuple(j if i == 30 else i for j in range(20)) + (i,) for i in range(31)]
    found = discovery.unique_sets(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)), most=1)
    assert [r.columns for r in found.collect()] == [["u"]] and len(written) == 1
    # Times that differ by a microsecond, and maps.
    moments = spark.sql(
        "select timestamp_micros(id) as at, map('k', id % 2) as m, cast(id as int) div 2 as n from range(4)"
    )
    assert sorted(r.columns for r in discovery.unique_sets(moments).collect()) == [["at"], ["m", "n"]]


# --- totals as of many dates -------------------------------------------------------


def test_totals_as_of_match_brute_force(spark):
    from lakeloom.operators.asof import totals_as_of

    rng = random.Random(2)
    entries = [(rng.choice([None, *range(6)]), rng.choice([None, *range(50)]), rng.randrange(100), rng.choice([None, 1])) for _ in range(400)]
    entries += [(7, i, 1, 2) for i in range(3000)]  # one key reaches over several ranges
    asked = [(rng.choice([None, *range(9)]), rng.choice([None, *range(-3, 60)])) for _ in range(200)]
    asked += [(7, i) for i in range(0, 3000, 97)]
    got = totals_as_of(
        spark.createDataFrame(entries, "k int, at int, x int, y bigint"),
        spark.createDataFrame(asked, "k int, at int"),
        "k", "at", ["x", "y"],
    ).collect()
    want = {}
    for k, at in asked:
        held = [e for e in entries if k is not None and at is not None and e[0] == k and e[1] is not None and e[1] <= at]
        want[k, at] = (sum(e[2] for e in held), sum(e[3] or 0 for e in held))
    assert len(got) == len(want) and {(r.k, r.at): (r.x, r.y) for r in got} == want
