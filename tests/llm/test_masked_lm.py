from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import masked_lm
from lakeloom.llm.queries import QUERIES
from tests.llm.data import FOLDER, awkward, documents, nothing


@pytest.fixture(scope="module")
def model(spark):
    return masked_lm.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def slow_scores(network: masked_lm.Network, text: str) -> list[float]:
    p, ids = network.p, network.tokens(text.encode()).tolist()
    out = []
    for t, target in enumerate(ids):
        h = p["near_bias"].astype(float)
        for j, place in enumerate(masked_lm.PLACES):
            near = ids[t + place] if 0 <= t + place < len(ids) else 0
            h = h + p["near"][j][near]
        h = np.tanh(h)
        kind, word = divmod(target, masked_lm.CLASS_SIZE)
        logits = h @ p["classes"] + p["class_bias"]
        value = logits[kind] - np.log(np.exp(logits).sum())
        logits = h @ p["words"][kind] + p["word_bias"][kind]
        out.append(value + logits[word] - np.log(np.exp(logits).sum()))
    return out


def test_scores_match_brute_force(spark, model):
    network = masked_lm.Network(*model)
    texts = {r.doc_id: r.text for r in documents(spark).limit(25).collect()}
    rows = masked_lm.score(documents(spark), *model).where(
        f"doc_id in ({','.join(map(str, texts))})"
    ).collect()
    for r in rows:
        want = slow_scores(network, texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.pseudo_log_likelihood == pytest.approx(sum(want), rel=1e-4, abs=1e-3)
        if want:
            assert r.mean_log_probability == pytest.approx(sum(want) / len(want), rel=1e-4, abs=1e-3)


def test_probabilities_of_all_words_add_up(model):
    network = masked_lm.Network(*model)
    line = np.array([0, 0, 5, 0, 9, 0, 0], np.int32)
    total = 0.0
    for word in range(masked_lm.VOCABULARY):
        line[3] = word
        total += np.exp(network.log_probabilities(line, np.array([3])))[0]
    assert total == pytest.approx(1, abs=1e-3)


def test_vocabulary_counts_the_whole_corpus(spark):
    docs = documents(spark)
    ids, counts = masked_lm.vocabulary(docs.select("text"))
    words: Counter = Counter()
    for r in docs.collect():
        words.update(r.text.encode().translate(masked_lm.WORD_BYTES).split())
    assert counts.sum() == sum(words.values())
    assert all(counts[i] == words[w] for w, i in ids.items())
    assert min(words[w] for w in ids) >= max(n for w, n in words.items() if w not in ids)


def test_training_helps_held_out_texts_and_needs_their_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    held = docs.where("doc_id % 10 = 0")
    seen = docs.where("doc_id % 10 <> 0")
    ids, trained = masked_lm.fit(seen)
    untrained = masked_lm.start(masked_lm.vocabulary(seen.select("text"))[1])
    untrained |= {"classes": untrained["classes"] * 0, "words": untrained["words"] * 0}

    def mean(parameters, df):
        row = masked_lm.score(df, ids, parameters).selectExpr(
            "sum(pseudo_log_likelihood) / sum(n_tokens) as m"
        )
        return row.first().m

    assert mean(trained, held) > mean(untrained, held) + 0.05
    random.seed(8)
    mixed = []
    for r in held.collect():
        words = r.text.split()
        random.shuffle(words)
        mixed.append((r.doc_id, " ".join(words)))
    mixed = spark.createDataFrame(mixed, "doc_id bigint, text string")
    assert mean(trained, held) > mean(trained, mixed)


def test_gradients_match_differences():
    network = masked_lm.Network({}, masked_lm.start(np.ones(masked_lm.VOCABULARY)))
    line = np.random.default_rng(0).integers(0, masked_lm.VOCABULARY, 40).astype(np.int32)
    at = np.arange(2, 38)
    before = {k: v.astype(np.float64) for k, v in network.p.items()}
    squares = {k: np.zeros(s, np.float32) for k, s in masked_lm.SHAPES.items()}
    network.p = {k: v.copy() for k, v in before.items()}
    network.train(line, at, squares)
    for name in masked_lm.SHAPES:
        flat = np.abs(squares[name]).ravel().argmax()
        loss = []
        for step in (1e-5, -1e-5):
            network.p = {k: v.copy() for k, v in before.items()}
            network.p[name].ravel()[flat] += step
            loss.append(-network.log_probabilities(line, at).mean())
        assert abs(loss[0] - loss[1]) / 2e-5 == pytest.approx(np.sqrt(squares[name].ravel()[flat]), rel=1e-2)


def test_awkward_rows(spark, model):
    rows = masked_lm.score(awkward(spark), *model).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (2, 3, 4):
        assert tuple(by_id[i])[1:] == (0, 0.0, None)
    assert by_id[5].n_tokens == 8 * 4000 and by_id[7].n_tokens == 2
    ids, parameters = masked_lm.fit(nothing(spark))
    assert ids == {} and masked_lm.score(nothing(spark), ids, parameters).count() == 0
    assert len(masked_lm.score(awkward(spark), *masked_lm.fit(awkward(spark))).collect()) == 11


@pytest.mark.parametrize("remembered", [1 << 17, 20])
def test_words_have_their_share_of_a_bucket(spark, monkeypatch, remembered):
    monkeypatch.setattr(masked_lm, "REMEMBERED", remembered)
    seen = documents(spark).where("doc_id % 5 <> 0")
    counted = masked_lm.word_counts(seen)
    model = masked_lm.fit(seen, counted=counted)
    network = masked_lm.Network(*model)
    rows = masked_lm.score(documents(spark), *model, counted=counted).collect()
    words: Counter = Counter()
    for r in seen.collect():
        words.update(r.text.encode().translate(masked_lm.WORD_BYTES).split())
    buckets: Counter = Counter()
    for w, n in words.items():
        if w not in model[0]:
            buckets[zlib.crc32(w) % masked_lm.BUCKETS] += n

    def share(word):
        if word in model[0]:
            return 0.0
        return np.log(max(words[word], 1) / (buckets[zlib.crc32(word) % masked_lm.BUCKETS] + 1))

    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in sorted(rows)[:40]:
        found = texts[r.doc_id].encode().translate(masked_lm.WORD_BYTES).split()
        want = sum(slow_scores(network, texts[r.doc_id])) + sum(map(share, found))
        assert r.n_tokens == len(found)
        assert r.pseudo_log_likelihood == pytest.approx(want, rel=1e-4, abs=1e-3)
        if found:
            assert r.mean_log_probability == pytest.approx(want / len(found), rel=1e-4, abs=1e-3)


def test_query_rates_unique_words_below_their_bucket(spark):
    docs = documents(spark)
    model = masked_lm.fit(docs)
    whole = {r.doc_id: r.pseudo_log_likelihood for r in masked_lm.score(docs, *model).collect()}
    rows = QUERIES["op5_masked_lm_scores"](spark, FOLDER).collect()
    assert all(r.pseudo_log_likelihood <= whole[r.doc_id] + 1e-3 for r in rows)
    assert sum(r.pseudo_log_likelihood for r in rows) < 1.1 * sum(whole.values())


def test_awkward_rows_with_shares(spark):
    counted = masked_lm.word_counts(awkward(spark))
    model = masked_lm.fit(awkward(spark), counted=counted)
    rows = masked_lm.score(awkward(spark), *model, counted=counted).collect()
    assert len(rows) == 11
    assert all(tuple(r)[1:] == (0, 0.0, None) for r in rows if r.doc_id in (2, 3, 4))
    counted = masked_lm.word_counts(nothing(spark))
    model = masked_lm.fit(nothing(spark), counted=counted)
    assert masked_lm.score(nothing(spark), *model, counted=counted).count() == 0
    # no counts: every word is one never seen
    assert len(masked_lm.score(awkward(spark), *model, counted=counted).collect()) == 11
