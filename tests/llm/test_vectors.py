from __future__ import annotations

import math

import numpy as np
import pytest

from lakeloom.llm import vectors
from lakeloom.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, unit string, cid bigint"


def slow(rows, threshold):
    """(vec_id, n_links, component_id, kept) by comparing all rows."""
    units = []
    for vec_id, x, label, *_ in rows:
        good = vec_id is not None and label is not None and x and None not in x
        good = good and all(map(math.isfinite, x)) and any(x)
        v = np.array(x, np.float64) if good else None
        units.append(v / np.linalg.norm(v) if good else None)
    n = len(rows)
    near = [[False] * n for _ in range(n)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2]:
                continue
            if len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                near[i][j] = near[j][i] = True
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        low = r[0]
        if units[i] is not None:
            low = min(rows[j][0] for j in range(n) if units[j] is not None and find(j) == find(i))
        out.append((r[0], sum(near[i]), low, r[0] is not None and r[0] == low))
    return sorted(out, key=repr)


def clusters(n_groups, size, spread, seed=0, dims=16):
    random = np.random.default_rng(seed)
    rows = []
    for g in range(n_groups):
        center = random.normal(size=dims)
        for _ in range(size):
            x = center + random.normal(size=dims) * spread
            rows.append((len(rows), x.astype(np.float32).tolist(), g % 2, "k", "u", 1))
    return rows


def check(spark, rows, threshold=0.93, **options):
    df = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), threshold, **options)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, df.collect()), key=repr) == slow(rows, threshold)


def test_one_block_matches_brute_force(spark):
    check(spark, clusters(20, 8, 0.15))


def test_parted_shards_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 64)
    monkeypatch.setattr(vectors, "PER_PIVOT", 16)
    check(spark, clusters(60, 5, 0.1, seed=1))


@pytest.mark.parametrize(("spread", "dims"), [(0.2, 16), (0.25, 6), (0.5, 3)])
def test_links_across_cells_are_found(spark, monkeypatch, spread, dims):
    monkeypatch.setattr(vectors, "SHARD", 64)
    monkeypatch.setattr(vectors, "PER_PIVOT", 16)
    check(spark, clusters(1, 500, spread, seed=6, dims=dims), min_recall=0)


def test_linked_members_share_a_cell():
    x = np.array([r[1] for r in clusters(3, 400, 0.4, seed=7, dims=4)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    pivots = vectors.apart(x[::8], 0.93)
    held = vectors.cells(x, pivots, 0.93)
    a, b = np.nonzero(x @ x.T >= 0.93)
    near = (x @ pivots.T).max(axis=1) >= 0.93
    assert len(pivots) > 5 and (held[a] & held[b]).any(axis=1)[near[a]].all()
    assert held.sum() < 0.5 * held.size


def test_hot_group_is_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 32)
    monkeypatch.setattr(vectors, "PER_PIVOT", 8)
    check(spark, clusters(1, 150, 0.05, seed=2) + [(1000 + i, *r[1:]) for i, r in enumerate(clusters(30, 2, 0.1, 3))])


def test_shards_without_a_pivot_are_drawn_again(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 8)
    monkeypatch.setattr(vectors, "PER_PIVOT", 12)
    check(spark, clusters(40, 3, 0.1, seed=5))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (1, a, 1, "", "", 0),
        (2, [2.0, 0.0, 0.0], 1, "", "", 0),
        (3, a, None, "", "", 0),
        (4, None, 1, "", "", 0),
        (5, [], 1, "", "", 0),
        (6, [0.0, 0.0, 0.0], 1, "", "", 0),
        (7, [1.0, nan, 0.0], 1, "", "", 0),
        (8, [inf, 0.0, 0.0], 1, "", "", 0),
        (9, [1.0, None, 0.0], 1, "", "", 0),
        (10, [1.0, 0.0], 1, "", "", 0),
        (11, b, 1, "", "", 0),
        (11, b, 1, "", "", 0),
        (12, a, 2, "", "", 0),
        (13, b, 2, "", "", 0),
        (13, a, 2, "", "", 0),
        (None, a, 1, "", "", 0),
        (14, [1e-30, 1e-32, 0.0], 1, "", "", 0),
        (15, [3e38, 3e37, 0.0], 1, "", "", 0),
    ]
    check(spark, rows)
    empty = vectors.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


def test_low_recall_stops_the_run(spark, monkeypatch):
    monkeypatch.setattr(vectors, "links", lambda members, near, weights, t: members.selectExpr(
        "cid", "cid as root", "0L as links").limit(0))
    with pytest.raises(RuntimeError):
        check(spark, clusters(4, 8, 0.05))


def test_pruned_graph_reaches_every_node():
    x = np.array([r[1] for r in clusters(30, 20, 0.05, seed=4)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = vectors.robust_prune(x)
    graph = vectors.local_graph(np.arange(len(x)), [n[n >= 0] for n in near])
    a, b = vectors.search(x, graph, x, 0.93)
    found = set(zip(a.tolist(), b.tolist()))
    want = set(zip(*[v.tolist() for v in np.nonzero(x @ x.T >= 0.93)]))
    assert len(found & want) >= 0.99 * len(want) and found <= want


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, folder):
    name = "op9_embedding_near_dedup"
    df = QUERIES[name](spark, folder)
    want = connect(folder).sql(ORACLES[name])
    got = [tuple(r) for r in df.collect()]
    assert difference(df.columns, got, list(want.columns), want.fetchall()) is None
