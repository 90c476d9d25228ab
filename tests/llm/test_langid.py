from __future__ import annotations

import zlib

import numpy as np

from lakeloom.llm import langid
from tests.llm.data import awkward, documents, nothing


def slow_profile(text: str) -> np.ndarray:
    """Bind and bundle one trigram after another."""
    profiler = langid.Profiler()
    plain = profiler.vectors[2].astype(int)
    letters, last = [0], 0
    for char in text + " ":
        symbol = profiler.letter(ord(char.lower()[0])) if char.isalpha() else 0
        if symbol or last:
            letters.append(symbol)
        last = symbol
    total = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(plain[a], 2) * np.roll(plain[b], 1) * plain[c]
    return total


def test_profile_matches_brute_force():
    profiler = langid.Profiler()
    for text in ("Hello, world! Grüße 漢字", "a", "--a--b  c", "x" * 50):
        assert np.allclose(profiler.profile(text), slow_profile(text))


def test_pieces_of_a_long_text_count_as_one(monkeypatch):
    text = "Several words, and some more: è é ö. " * 40
    whole = langid.Profiler().profile(text)
    monkeypatch.setattr(langid, "CHARS_AT_ONCE", 7)
    assert np.allclose(langid.Profiler().profile(text), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    for r in found.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1


def test_held_out_labels_are_not_learnt(spark):
    docs = documents(spark)
    other = docs.selectExpr(
        "doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'zz' else lang end as lang"
    )
    assert sorted(langid.identify(docs).collect()) == sorted(langid.identify(other).collect())


def test_awkward_rows(spark):
    found = langid.identify(awkward(spark)).collect()
    assert len(found) == 11
    undetermined = [r for r in found if r.lang_pred == "und"]
    assert {r.doc_id for r in undetermined} == {2, 3, 4, 7, None}
    assert all(r.score == 0 for r in undetermined) and len(undetermined) == 5
    assert langid.identify(nothing(spark)).count() == 0
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_identified_documents_stay_as_they_are(spark):
    docs = awkward(spark)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 6
    before = {tuple(r)[:2] + tuple(r)[3:] for r in docs.collect()}
    for r in kept.collect():
        assert tuple(r)[:2] + tuple(r)[3:] in before and r.lang == "xx"
