from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import phrases
from tests.llm.data import FOLDER, awkward, nothing, plain
from tests.oracle import connect, difference


def slow(rows: list[tuple], least: int = 30, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows, by the rules."""
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for d in range(1, 5):
                for i in range(len(words) - d + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + d])] += 1
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in candidates.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            held = any(
                100 * b >= 80 * a
                for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if not held:
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found, key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")


def mixed(n: int) -> list[tuple]:
    rng = np.random.default_rng(5)
    words = ["the", "of", "New", "YORK", "city", "état", "漢", "a|b", "x\x00y", " ", "'s", "rare"]
    rows = []
    for i in range(n):
        chosen = rng.choice(words, size=rng.integers(0, 40), p=[0.25, 0.15] + [0.06] * 10)
        ends = rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n", "!", "  "], size=len(chosen))
        rows.append(([None, "en", "und", "fr"][i % 4], "".join(w + e for w, e in zip(chosen, ends))))
    return rows


def test_counts_and_scores_match_brute_force(spark):
    rows = mixed(1200) + [("en", "new york city " * 4000), ("en", None), ("en", ""), (None, " \t.,\n")]
    got = phrases.collocations(docs_of(spark, rows).repartition(6))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = slow(rows)
    assert len(want) > 100
    assert plain(got) == want


@pytest.mark.parametrize("budget", [1, 50, 1 << 20])
def test_groups_of_any_size_give_the_same_rows(spark, budget):
    rows = mixed(300)
    got = phrases.collocations(docs_of(spark, rows), least=5, top=40, budget=budget)
    assert plain(got) == slow(rows, least=5, top=40)


def test_given_table_matches_sql(spark):
    from lakeloom.llm import queries

    got = queries.op13_collocations(spark, "/root/testdata/sf0.01")
    want = connect("/root/testdata/sf0.01").sql(queries.ORACLES["op13_collocations"])
    rows = [tuple(r) for r in got.collect()]
    assert difference(got.columns, rows, list(want.columns), want.fetchall()) is None


def test_awkward_rows(spark):
    docs = awkward(spark)
    want = slow([(r.lang, r.text) for r in docs.collect()], least=2)
    assert want and plain(phrases.collocations(docs, least=2)) == want
    assert phrases.collocations(nothing(spark)).collect() == []


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    rows = [("en", "one two three " * 40)]
    real = phrases.xxhash.xxh64_intdigest

    class Weak:
        @staticmethod
        def xxh64_intdigest(word, seed):
            return 7 if seed == 0 else real(word, seed)

    monkeypatch.setattr(phrases, "xxhash", Weak)
    docs = docs_of(spark, rows)
    _, seed = phrases.words_with_ids(phrases.rows_of(docs, "lang", "text"))
    assert seed == 1
    assert plain(phrases.collocations(docs)) == slow(rows)


def test_loads_cover_every_suffix(spark):
    """Groups stay within one and a half budgets, but for suffixes that are all the same."""
    docs = docs_of(spark, mixed(1500))
    rows = phrases.rows_of(docs, "lang", "text")
    words, seed = phrases.words_with_ids(rows)
    marks = phrases.marks_of(words, 5)
    groups = phrases.partitioned(rows, words, seed, marks, 200)
    assert len(groups.loads) == 4
    shared = spark.sparkContext.broadcast((marks, groups))
    held: dict[int, list] = {}
    for r in phrases.dealt(rows, seed, shared).collect():
        held.setdefault(r.part, []).append(phrases.unpacked(r.suffixes, r.n))
    for found in map(np.concatenate, held.values()):
        distinct = len(np.unique(found[["w1", "w2", "w3", "w4"]]))
        assert found["n"].sum() <= 1.5 * groups.budget or distinct <= 1.5 * groups.budget
