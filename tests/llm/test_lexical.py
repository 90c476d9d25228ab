from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import lexical
from tests.llm.data import FOLDER, awkward, documents, nothing, plain

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_rank(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    rows = []
    for item, text in items:
        scores = []
        for doc_id, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:k], 1):
            rows.append((item, rank, None if null else doc_id, -score))
    return sorted(rows, key=repr)


def test_ranks_match_brute_force(spark):
    docs = documents(spark)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = slow_rank(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    got = lexical.rank(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(got) == want
    # Several slices of items, tiny tiles: the same rows.
    sliced = lexical.rank(docs, items, slice_bytes=4096)
    assert plain(sliced) == want


def test_tiles_do_not_change_results(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 64)
    monkeypatch.setattr(lexical, "VOCABULARY_TILE", 5)
    monkeypatch.setattr(lexical, "ITEM_TILE", 2)
    docs = [(i, f"w{i % 3} w{i % 5} w{i % 7} common") for i in range(300)]
    items = [(1, "w0 w1"), (2, "w4 w6 W6"), (3, "common"), (4, "absent"), (5, "w1 w2 w3 w4 w5 w6")]
    got = lexical.rank(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert plain(got) == slow_rank(docs, items)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(500, 0, -1)] + [(None, "same words here"), (7, "same words here")]
    docs += [(1000 + i, "other text") for i in range(600)]
    items = [(1, "same"), (1, "words"), (None, "here")]
    got = lexical.rank(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    rows = plain(got)
    assert rows == slow_rank(docs, items)
    assert [r[2] for r in sorted(rows, key=lambda r: r[1]) if r[0] is None] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, "FOX lazy漢字 漢字"), (2, None), (3, "..."), (4, "lorem dolor \u0000 12345")],
        "item_id bigint, text string",
    )
    want = slow_rank([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert plain(lexical.rank(docs, items)) == want
    assert lexical.rank(nothing(spark), items).collect() == []
    assert lexical.rank(docs, items.limit(0)).collect() == []
    assert lexical.rank(docs.where("doc_id in (2, 3, 4)"), items).collect() == []


def test_long_text_is_cut_at_words_only(spark, monkeypatch):
    from lakeloom.llm import words

    monkeypatch.setattr(words, "AT_ONCE", 50)
    import pyarrow as pa

    texts = ["ab cd! " * 40 + "x" * 9000 + " Tail", None, "", "É" * 100, "q"]
    found = words.words_of(pa.array(texts, pa.string()), lexical.TERM)
    got = [(r, found.dictionary[c].as_py().decode()) for r, c in zip(found.rows.tolist(), found.codes.tolist())]
    assert got == [(i, w) for i, t in enumerate(texts) for w in terms(t)]


def test_sums_stay_below_exact_doubles():
    weights = np.full(20_000, 40_000_000_000 // 10)
    tiles = lexical.cuts(weights)
    assert tiles[0][0] == 0 and tiles[-1][1] == len(weights)
    assert all(a[1] == b[0] for a, b in zip(tiles, tiles[1:]))
    assert all(int(weights[a:b].sum()) * lexical.MOST < lexical.EXACT for a, b in tiles)


@pytest.mark.parametrize("n", [1, 10**7])
def test_impact_does_not_overflow(n):
    docs, total = 5 * 10**10, 10**13
    got = lexical.impacts(np.array([3]), np.array([n]), docs, total)
    assert got.tolist() == [3 * 10**9 // (3000 + 8 * (10 + 90 * n * docs // total))]
