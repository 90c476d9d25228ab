from __future__ import annotations

import random

import numpy as np
import pytest

from lakeloom.llm import decontam
from tests.llm.data import FOLDER, LONG, awkward, documents, nothing


def slow_distances(words: list[bytes], text: bytes) -> np.ndarray:
    """Fewest edits between each word and any region of the text; the words are as long.

    The whole table of edits, a column of it for each byte of the text, all words at once.
    """
    letters = np.array([list(w) for w in words], np.uint8).reshape(len(words), -1)
    steps = np.arange(letters.shape[1] + 1, dtype=np.int8 if letters.shape[1] < 120 else np.int32)
    column = np.repeat(steps[None], len(words), 0)
    best = column[:, -1].copy()
    for d in text:
        new = np.zeros_like(column)
        np.minimum(column[:, :-1] + (letters != d), column[:, 1:] + 1, out=new[:, 1:])
        # A byte of the word without mate costs one more than the row above.
        column = np.minimum.accumulate(new - steps, axis=1) + steps
        np.minimum(best, column[:, -1], out=best)
    return best


def slow_found(index: decontam.Index, text: bytes) -> dict[int, int]:
    found: dict[int, int] = {}
    text = decontam.normal(text)
    by_length: dict[int, list[int]] = {}
    for i, window in enumerate(index.windows):
        by_length.setdefault(len(window), []).append(i)
    for group in by_length.values():
        for i, distance in zip(group, slow_distances([index.windows[i] for i in group], text).tolist()):
            if distance <= index.edits[i]:
                owner = int(index.owners[i])
                found[owner] = min(distance, found.get(owner, distance))
    return found


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]


def noisy(text: bytes, edits: int) -> bytes:
    out = bytearray(text)
    for _ in range(edits):
        at = random.randrange(len(out))
        kind = random.randrange(3)
        if kind == 0:
            out[at] = random.randrange(97, 123)
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, random.randrange(97, 123))
    return bytes(out)


def test_findings_match_brute_force(spark, items):
    random.seed(9)
    index = decontam.Index(items[:12], decontam.WINDOW_BYTES, decontam.EDIT_RATE)
    docs = [r.text.encode()[:400] for r in documents(spark).limit(10).collect()]
    texts = []
    for k in range(40):
        item = decontam.normal(items[k % 12][1])
        part = item[random.randrange(40) :] if k % 3 == 0 else item
        texts.append(docs[k % 10][:150] + b" " + noisy(part, k % 16) + b" " + docs[(k + 1) % 10][:90])
    want = [slow_found(index, t) for t in texts]
    assert sum(map(bool, want)) > 20
    got = decontam.scan(index, texts)
    # The fewest edits may lie outside the band of the first finding, the items may not.
    assert [sorted(g) for g in got] == [sorted(w) for w in want]
    assert got == want
    assert [decontam.found_in(index, decontam.normal(t), 256) for t in texts] == want


def test_excerpts_are_found_wherever_they_start(items):
    """Every excerpt of a window's length, between other text; some with edits of their own."""
    random.seed(4)
    item = max((decontam.normal(t) for _, t in items), key=len)
    item = (item + b" " + item[::-1]) * 2
    index = decontam.Index([(1, item)], decontam.WINDOW_BYTES, decontam.EDIT_RATE)
    other = b"0123456789 " * 20
    texts, spoilt = [], []
    for start in range(len(item) - decontam.WINDOW_BYTES + 1):
        excerpt = item[start : start + decontam.WINDOW_BYTES]
        texts.append(other + excerpt + other)
        spoilt.append(other + noisy(excerpt, 3) + other)
    assert len(texts) > 500
    assert all(found == {1: found.get(1)} for found in decontam.scan(index, texts))
    assert all(1 in found for found in decontam.scan(index, spoilt))


def test_slices_do_not_pile_up_in_a_stage(spark):
    docs, benchmark = documents(spark), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    total = benchmark.selectExpr("sum(octet_length(text))").first()[0]
    many = decontam.contamination(docs, benchmark, slice_bytes=total // 9)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("MapInArrow") <= decontam.SLICES_A_STAGE


def test_lemma_holds_for_every_window(items):
    index = decontam.Index(items, decontam.WINDOW_BYTES, decontam.EDIT_RATE)
    for window, edits, bound in zip(index.windows, index.edits, index.bound):
        assert bound >= 1 and edits <= len(window) * decontam.EDIT_RATE
        assert bound == max(1, len(window) + 1 - decontam.Q * (edits + 1))


def test_items_in_documents_are_found(spark, items):
    rows = decontam.contamination(
        documents(spark), spark.read.parquet(f"{FOLDER}/benchmark.parquet"), keep=["doc_id", "text"]
    ).collect()
    assert len(rows) == 200
    for r in rows:
        text = decontam.normal(r.text.encode())
        inside = {i for i, t in items if decontam.normal(t) in text}
        assert inside <= set(r.item_ids)
        assert (r.min_edits == 0) if inside else True
        assert (r.min_edits is None) == (not r.item_ids)
    assert any(r.item_ids for r in rows) and not all(r.item_ids for r in rows)


def test_slices_of_the_benchmark_give_the_same(spark):
    docs, benchmark = documents(spark), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    one = decontam.contamination(docs, benchmark)
    many = decontam.contamination(docs, benchmark, slice_bytes=3000)
    assert sorted(one.collect(), key=repr) == sorted(many.collect(), key=repr)


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame(
        [
            (1, "a quick brown fox jumps over the lazy dog and runs away into the woods"),
            (2, None),
            (None, "some text"),
            (3, ""),
            (4, "12345"),
            (5, LONG[:900]),
            (6, "THE QUICK  brown fox jumps over the lazy dog."),
        ],
        "item_id bigint, text string",
    )
    rows = decontam.contamination(awkward(spark), benchmark).collect()
    found = {r.doc_id: r.item_ids for r in rows if r.item_ids}
    assert len(rows) == 11 and found == {1: [6], 5: [5], 6: [6], None: [6]}
    assert decontam.contamination(nothing(spark), benchmark).count() == 0
    none = decontam.contamination(awkward(spark), benchmark.limit(0)).collect()
    assert len(none) == 11 and not any(r.item_ids for r in none)
    exact = spark.createDataFrame([(9, " 12345 ")], "doc_id bigint, text string")
    assert decontam.contamination(exact, benchmark).first().item_ids == [4]
    kept = decontam.keep_uncontaminated(awkward(spark), benchmark)
    assert kept.columns == awkward(spark).columns and kept.count() == 6
