from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from lakeloom.llm import rans
from lakeloom.llm.queries import QUERIES
from lakeloom.session import scratch_path
from tests.llm.data import awkward, nothing

DEFINITION = rans.definition_of(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def words():
    return rans.WordTokenizer(DEFINITION)


def test_empty_words_only(words):
    fresh = rans.WordTokenizer(DEFINITION)
    assert [w.tolist() for w in fresh.encode(pa.array(["", " ", None]))] == [[], [], []]


def whole(words, texts):
    return [e.ids for e in words.full.encode_batch(texts, add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts(words):
    random.seed(6)
    texts = ["it's don't <|endoftext|>a b<|ENDOFTEXT|>. x...", "É! Straße ǅ İx ŉ", "x\x1cz \x85 a\u00a0b", "x́. ."]
    alphabet = "aéÉßZ .,!?'<|>1\u0301 \n漢x:\u2028s"
    texts += ["".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(3000)]
    assert [w.tolist() for w in words.encode(pa.array(texts))] == whole(words, texts)


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 140_000, rans.BLOCK])
def test_blocks_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 5000).astype(np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    assert table.freq.sum() == 1 << table.bits and table.freq.min() >= 1
    payload = rans.pack(table, ids, [rans.Part(7, 1, 0, n, n)])
    parts, back = rans.unpack(table, payload)
    assert (back == ids).all() and parts["doc_id"].tolist() == [7]
    for first, last in ((0, 1), (n // 2, n // 2 + 10), (n - 1, n), (rans.CHECKPOINT, rans.CHECKPOINT + 9)):
        assert (rans.unpack(table, payload, first, last)[1] == ids[first:last]).all()
    if n > 130_000:  # near the entropy
        p = np.unique(ids, return_counts=True)[1] / n
        bound = -(p * np.log2(p)).sum() * n / 8
        extra = n // rans.CHECKPOINT * 8 * (rans.LANES + 1) + 8 * (rans.LANES + 1) + 200
        assert len(payload) < bound * 1.01 + extra


def test_large_and_single_ids():
    for ids in (np.array([1 << 31, 5, 1 << 31], np.uint32), np.full(1000, 7, np.uint32)):
        table = rans.Table(*np.unique(ids, return_counts=True))
        assert (rans.unpack(table, rans.pack(table, ids, []))[1] == ids).all()


def test_damage_is_noticed():
    ids = (np.random.default_rng(1).zipf(1.3, 5000) % 50).astype(np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    payload = bytearray(rans.pack(table, ids, []))
    payload[-2000] ^= 1  # an early word; the last ones are not read to their last bit
    with pytest.raises(ValueError):
        rans.unpack(table, bytes(payload))
    with pytest.raises(ValueError):
        rans.unpack(table, b"xxxx" + bytes(payload[4:]))


def test_joined_checksums():
    a, b = b"hello" * 100, b"wor\0ld" * 77
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rans.crc32_joined(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def expected(words, rows):
    """(doc_id, start, n_tokens, ids_crc32) in ascending order of ids."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole(words, [text or ""])[0] + [1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_matches_brute_force(spark, words):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op7_rans_token_files"](spark, folder).collect())
    assert got == expected(words, rows)


def test_documents_over_blocks(spark, words, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 2048)
    monkeypatch.setattr(rans, "CHECKPOINT", 1024)
    rows = [(i, f"token {i} is here, " * (1 + 97 * i % 3000)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = scratch_path(spark, "rans-test")
    rans.write(docs, DEFINITION, path)
    assert sorted(tuple(r) for r in rans.digests(spark, path).collect()) == expected(words, rows)
    together: dict[int, list] = {}
    for r in sorted(rans.read(spark, path).collect(), key=lambda r: r.start):
        assert r.skipped == len(together.setdefault(r.doc_id, []))
        together[r.doc_id] += r.ids
    assert together == {i: whole(words, [t])[0] + [1] for i, t in rows}


def test_awkward_rows(spark, words):
    docs = awkward(spark)
    path = scratch_path(spark, "rans-test")
    rans.write(docs, DEFINITION, path)
    got = [tuple(r) for r in rans.digests(spark, path).collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(words, rows)
    # Rows of one id (or none) are in no particular order among themselves.
    assert sorted(((a, n, c) for a, _, n, c in got), key=repr) == sorted(((a, n, c) for a, _, n, c in want), key=repr)
    ends = sorted((s, s + n) for _, s, n, _ in got)
    assert ends[0][0] == 0 and all(x[1] == y[0] for x, y in zip(ends, ends[1:]))
    by_start = [i for i, *_ in sorted(got, key=lambda r: r[1])]
    assert by_start == sorted(by_start, key=lambda i: (i is not None, i or 0))
    empty = scratch_path(spark, "rans-test")
    rans.write(nothing(spark), DEFINITION, empty)
    assert rans.digests(spark, empty).count() == 0
