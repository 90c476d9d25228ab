from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from lakeloom.llm import pieces
from lakeloom.llm.queries import piece_model
from tests.llm.data import awkward, documents, nothing


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(piece_model())


def slow_segment(p: pieces.Pieces, word: str) -> list[int]:
    """Viterbi over characters with a dictionary."""
    ids = {p.bytes_of[i].decode(): i for i in np.flatnonzero(p.score > -np.inf)}
    best = [(0.0, 0, None)] + [(-np.inf, 0, None)] * len(word)
    for i in range(len(word)):
        for k in range(i + 1, min(len(word), i + 48) + 1):
            i_d = ids.get(word[i:k])
            if i_d is not None and best[i][0] + p.score[i_d] > best[k][0]:
                best[k] = (best[i][0] + p.score[i_d], i, i_d)
            if k == i + 1 and best[i][0] + p.unknown > best[k][0]:
                best[k] = (best[i][0] + p.unknown, i, None)
    out, end = [], len(word)
    while end:
        _, i, piece = best[end]
        out[:0] = [piece] if piece is not None else p.byte_id[list(word[i:end].encode())].tolist()
        end = i
    return out


def test_segmentation_matches_brute_force(spark, encoder):
    p = encoder.pieces
    words = {"▁" + w for r in documents(spark).limit(40).collect() for w in r.text.split()}
    words = sorted(words)[:600] + ["▁漢字x", "▁▁▁a", "😀é", "▁" + "ab" * 90]
    want = [slow_segment(p, w) for w in words]
    assert p.segment([w.encode() for w in words]) == want
    assert [p.segment_long(w.encode()) for w in words] == want


def test_double_array_holds_exactly_the_pieces(encoder):
    p = encoder.pieces
    for i in np.flatnonzero(p.score > -np.inf)[::37]:
        state = 0
        for byte in p.bytes_of[i]:
            step = p.base[state] + byte + 1
            assert p.check[step] == state
            state = step
        assert p.piece_at[state] == i


def test_round_trip(encoder):
    random.seed(4)
    texts = ["", " ", "  a\n\nb  ", "É▁x 漢字 😀", "▁▁ ▁", "x\u0000y\tz", "a" * 300 + " " + "é" * 500]
    alphabet = "aé▁ \n漢😀thé"
    texts += ["".join(random.choices(alphabet, k=random.randint(0, 30))) for _ in range(500)]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert encoder.decode(ids).decode() == text


def test_texts_are_their_words(encoder):
    """Whole texts, segmented as one word, get the ids of their words."""
    for text in ("hello brave new world", "über  alles, im Wald"):
        marked = "▁" + text.replace(" ", "▁")
        assert encoder.encode([text.encode()])[0].tolist() == slow_segment(encoder.pieces, marked)


def test_memory_bound_changes_nothing(spark):
    texts = [r.text.encode() for r in documents(spark).limit(60).collect()]
    small, large = pieces.Encoder(piece_model()), pieces.Encoder(piece_model())
    small.words.limit = 1000
    one_by_one = [small.encode([t])[0] for t in texts]
    assert all((a == b).all() for a, b in zip(one_by_one, large.encode(texts)))


def test_encode_and_decode_tables(spark, encoder):
    docs = awkward(spark)
    model = piece_model()
    encoded = pieces.encode(docs, model, keep=["doc_id", "text"])
    back = pieces.decode(encoded.selectExpr("struct(doc_id, text) as row", "ids"), model, keep=["row"])
    for r in back.collect():
        assert r.text == r.row.text
    assert pieces.encode(nothing(spark), model).count() == 0
    digest = pieces.round_trip(docs, model).collect()
    assert len(digest) == 11 and all(r.same for r in digest)
    by_id = {r.doc_id: r for r in digest}
    assert (by_id[2].n_pieces, by_id[2].ids_crc32, by_id[3].n_pieces) == (0, 0, 0)
    ids = encoder.encode(["Ünïcödé 漢字 😀 \u0000 ▁ end".encode()])[0]
    assert by_id[8].ids_crc32 == zlib.crc32(ids.astype("<i4").tobytes())
    assert by_id[8].n_pieces == len(ids)
