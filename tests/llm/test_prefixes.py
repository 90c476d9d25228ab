from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from lakeloom.llm import prefixes, queries, rans
from tests.llm.data import FOLDER, awkward, documents, nothing, plain


@pytest.fixture(scope="module")
def definition():
    return rans.definition_of(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer(definition):
    return prefixes.PrefixTokenizer(definition)


def library(tokenizer, text: str) -> int:
    return len(tokenizer.full.encode(text, add_special_tokens=False).ids)


LETTERS = "abcdeinorst'’éßüæ漢字😀́12!.?,-_<|>ǅİſȺ각ᅡᆨ\xa0\x00\x85ñ   \n"


def random_texts(n: int) -> list[str]:
    rng = random.Random(17)
    texts = []
    for k in range(n):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 14)))
        if k % 7 == 0:
            text = text[:3] + rng.choice(["<|endoftext|>", "<|startoftext|>"]) + text[3:]
        if k % 11 == 0:
            text = rng.choice(["'s", "n't", "'re", "'ll", "!'s", "''ve", "I'LL"]) + text
        texts.append(text)
    return texts


def test_every_prefix_has_the_librarys_count(tokenizer):
    texts = random_texts(6000) + ["aaaaaaaaaaaaaaaaaaaaaaaaa", "don't", "x<|endoftext|>y", "<|endoftext|"]
    for text, changes in zip(texts, tokenizer.changes(pa.array(texts))):
        counts, at = np.cumsum(changes), 0
        assert len(changes) == len(text.encode())
        parts = prefixes.clusters(text)
        for i, part in enumerate(parts):
            at += len(part.encode())
            assert counts[at - 1] == library(tokenizer, "".join(parts[: i + 1])), (text, i)


def test_prefixes_of_words_of_the_corpus(spark, tokenizer):
    words = sorted({w for r in documents(spark).collect() for w in (r.text or "").split()})
    rng = random.Random(3)
    for word in rng.sample(words, 1500):
        counts, at = np.cumsum(tokenizer.word(word)), 0
        for i, c in enumerate(word):
            at += len(c.encode())
            assert counts[at - 1] == library(tokenizer, word[: i + 1])


def test_counts_of_whole_texts(spark):
    rows = {r.doc_id: r for r in queries.op11_prefix_token_counts(spark, FOLDER).collect()}
    docs = documents(spark).collect()
    assert len(rows) == len(docs)
    tokenizer = prefixes.PrefixTokenizer(rans.definition_of(public_tokenizers.path("word_bpe_49k.json")))
    assert any(r.over_limit for r in rows.values())
    for d in docs:
        r, text = rows[d.doc_id], d.text or ""
        n = library(tokenizer, text)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)
        if n <= 2048:
            assert r.cut_bytes == len(text.encode()) and r.cut_tokens == n


def test_cuts_are_the_longest_prefixes(spark, definition, tokenizer):
    texts = random_texts(300) + ["", "one two three four five six"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table = prefixes.prefix_table(docs, definition)
    for budget in (0, 1, 3, 100):
        for r in prefixes.within(table, budget).collect():
            text, best, at = texts[r.doc_id], 0, 0
            parts = prefixes.clusters(text)
            for i, part in enumerate(parts):
                at += len(part.encode())
                if library(tokenizer, "".join(parts[: i + 1])) <= budget:
                    best = at
            got = text.encode()[: r.cut_bytes]
            # Bytes inside a character repeat the count before it and are no place to cut.
            assert len(got.decode(errors="ignore").encode()) == len(got)
            assert r.cut_bytes == best
            assert r.cut_tokens == library(tokenizer, got.decode())


def test_awkward_rows(spark, definition, tokenizer):
    docs = awkward(spark)
    got = prefixes.prefix_table(docs, definition).select("doc_id", "n_bytes", "n_tokens")
    want = [(r.doc_id, len((r.text or "").encode()), library(tokenizer, r.text or "")) for r in docs.collect()]
    assert plain(got) == sorted(want, key=repr)
    assert prefixes.within(prefixes.prefix_table(nothing(spark), definition), 5).collect() == []


def test_widths():
    for values in ([], [1, -1], [300, -5], [70_000]):
        changes = np.array(values, np.int32)
        assert prefixes.running(prefixes.narrow(changes), len(values)).tolist() == np.cumsum(values, dtype=int).tolist()


def test_other_encodings_are_refused():
    with pytest.raises(ValueError, match="ends of words"):
        prefixes.Merges(rans.definition_of(public_tokenizers.path("byte_bpe_50k.json")))
