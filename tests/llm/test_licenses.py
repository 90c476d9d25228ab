from __future__ import annotations

import re

import pytest

from lakeloom.llm import licenses
from tests.llm.data import awkward, nothing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_base(text: str | None) -> tuple:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(labels))


def test_base_findings_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = licenses.licenses(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base(texts[r.doc_id])
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert any(r.n_base for r in rows)


def test_places_overlap_and_share_blanks(spark):
    text = "CC BY cc-by, CC\nBY-NC. All rights reserved; GNU General Public License é"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = licenses.licenses(docs).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (15, 5, 0, 11)
    assert row.base_labels == "cc-by,gpl,reserved"
    assert row.labels == "cc-by,cc-by-nc,gpl,reserved"


@pytest.mark.parametrize(
    ("expression", "order", "openness"),
    [
        ("MIT", ["mit"], 1.0),
        ("MIT OR GPL-2.0-only", ["mit", "gpl-2.0-only", "or"], 1.0),
        ("MIT AND GPL-2.0-only", ["mit", "gpl-2.0-only", "and"], 0.3),
        ("MIT or GPL-2.0 and MPL-2.0", ["mit", "gpl-2.0", "mpl-2.0", "and", "or"], 1.0),
        ("(MIT or GPL-2.0) and MPL-2.0", ["mit", "gpl-2.0", "or", "mpl-2.0", "and"], 0.6),
        ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0", "classpath-exception-2.0", "with"], 0.6),
        ("MIT */ int x;", ["mit"], 1.0),
        ("MIT is what we chose", ["mit"], 1.0),
        ("MIT AND", None, None),
        ("(MIT", None, None),
        ("OR MIT", None, None),
        ("()", None, None),
        ("", None, None),
    ],
)
def test_expressions(expression, order, openness):
    assert licenses.postfix(expression) == order
    if order:
        assert licenses.evaluate(order)[0] == pytest.approx(openness)


def test_tags(spark):
    texts = [
        "# SPDX-License-Identifier: Apache-2.0 OR MIT\ncode",
        "// spdx-license-identifier: (GPL-3.0",
        "spdx license identifier in words only",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sorted(licenses.licenses(docs).collect())
    assert [(r.labels, r.score, r.openness) for r in rows] == [
        ("apache-2.0,mit", 1.0, 1.0),
        ("", 0.5, None),
        ("", 0.0, None),
    ]


def test_awkward_rows(spark):
    rows = licenses.licenses(awkward(spark)).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (2, 3, 4):
        assert tuple(by_id[i])[1:] == (0, 0, None, None, "", "", 0.0, None)
    assert licenses.licenses(nothing(spark)).count() == 0
