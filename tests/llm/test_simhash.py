from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lakeloom.llm import simhash
from lakeloom.llm.shared import components
from tests.llm.data import awkward, documents, nothing


def slow_fingerprint(text: str | None, k: int = 4) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows: list[tuple[int | None, int]], bits: int) -> dict[int, int | None]:
    """Component of each fingerprint."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i:]:
            if bin(a ^ b).count("1") <= bits:
                parent[root(a)] = root(b)
    named: dict[int, int | None] = {}
    for doc, f in rows:
        r = root(f)
        old = named.get(r)
        named[r] = doc if old is None else old if doc is None else min(doc, old)
    return {f: named[root(f)] for f in fps}


def check(df, bits):
    source = [(r.doc_id, slow_fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]
    groups = slow_components(source, bits)
    want = sorted(((d, f"{f:016x}", groups[f]) for d, f in source), key=repr)
    got = sorted((tuple(r) for r in simhash.near_duplicates(df, 4, bits).collect()), key=repr)
    assert got == want


def test_documents_match_brute_force(spark):
    check(documents(spark), 4)


def test_other_distances_match_brute_force(spark):
    check(documents(spark), 7)
    check(documents(spark), 0)


def test_runs_of_a_long_text_count_as_one(monkeypatch):
    from lakeloom.llm import licenses, shared

    texts = [f"{'ab cd ' * n}all rights reserved cc by\tx" for n in (0, 1, 3, 40)] + ["one", "", " a b c"]
    phrases = licenses.automaton({p: (v, True) for p, v in licenses.BASE_PHRASES.items()})
    whole = [(simhash.fingerprint(t.encode(), 4), licenses.scan(t.encode(), phrases)) for t in texts]
    assert [f for f, _ in whole] == [np.array(slow_fingerprint(t), np.uint64).view(np.int64) for t in texts]
    for size in (1, 5, 17):
        monkeypatch.setattr(shared, "RUN_BYTES", size)
        assert [(simhash.fingerprint(t.encode(), 4), licenses.scan(t.encode(), phrases)) for t in texts] == whole


def test_awkward_rows(spark):
    check(awkward(spark), 4)
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_all_near_pairs_meet_at_an_anchor():
    random = np.random.default_rng(3)
    for bits in (1, 2, 4, 6):
        anchors = simhash.Anchors(-(-bits // 2))
        a = random.integers(-(2**63), 2**63 - 1, 60)
        b = a.copy()
        for i in range(len(b)):
            for bit in random.choice(64, bits, replace=False):
                b[i] ^= np.array([1 << int(bit)], np.uint64).view(np.int64)[0]
        (i, x), (j, y) = anchors.of(a), anchors.of(b)
        for k in range(len(a)):
            assert set(x[i == k]) & set(y[j == k])


def test_large_group_connects_like_all_its_links():
    random = np.random.default_rng(5)
    center = random.integers(-(2**63), 2**63 - 1, 8)
    fps = np.concatenate([center ^ (np.int64(1) << k) ^ (np.int64(1) << j) for k in range(30) for j in range(30)])
    rows = [(int(f), int(f) & (2**64 - 1)) for f in np.unique(fps)]
    slow = slow_components([(i, f) for i, (_, f) in enumerate(rows)], 4)
    a, b = simhash.links_in_group(fps, 4)
    assert (simhash.distance(a, b) <= 4).all()
    nodes, roots = simhash.forest(a, b)
    fast = dict(zip(nodes.tolist(), roots.tolist()))
    label = [fast.get(s, s) for s, _ in rows]
    want = [slow[u] for _, u in rows]
    assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_hot_anchors_are_dealt_to_pairs_of_blocks(spark, monkeypatch):
    """40,000 fingerprints at one anchor: bounded groups, and the components of plain search."""
    random = np.random.default_rng(7)
    words = np.array([w for w in range(1 << 23) if w.bit_count() <= simhash.GOLAY_RADIUS], np.int64)
    chosen = random.choice(len(words) ** 2, 40_000, replace=False)
    fps = np.unique(words[chosen // len(words)] | words[chosen % len(words)] << 23)
    distinct = spark.createDataFrame([(int(f),) for f in fps], "fp bigint").repartition(8)
    monkeypatch.setattr(simhash, "HOT_ROWS", 1 << 13)
    groups = simhash.dealt(distinct, 4).groupBy("anchor").count()
    sizes = groups.agg(F.max("count"), F.max(F.when(F.col("anchor") == 0, F.col("count")))).first()
    assert sizes[0] <= 1.1 * simhash.HOT_ROWS and sizes[1] is None  # zero is a word of each code
    got = simhash.links(distinct, 4).toPandas()
    a, b = got.a.to_numpy(), got.b.to_numpy()
    nodes, roots = simhash.forest(a, b)
    want = dict(zip(*(x.tolist() for x in simhash.forest(*simhash.links_in_group(fps, 4)))))
    assert dict(zip(nodes.tolist(), roots.tolist())) == want


def test_dealt_groups_find_what_whole_anchors_find(spark, monkeypatch):
    docs = documents(spark)
    rows = lambda: sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr)
    whole = rows()
    monkeypatch.setattr(simhash, "HOT_ROWS", 3)
    monkeypatch.setattr(simhash, "HOT_SHARE", 1 << 30)
    assert rows() == whole


def test_chains_and_hubs_are_one_component(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + hub + [(5, 5), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    want = {i: 100 for i in range(100, 161)} | {1000 + i: 1000 for i in range(200)}
    assert got == want


def test_one_document_of_each_group_stays(spark):
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 2, 5, 7, 8]  # 3 and 4 are blank like 2, 6 repeats 1
    assert kept.where("doc_id is null").count() == 2
