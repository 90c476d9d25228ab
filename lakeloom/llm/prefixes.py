"""Exact token counts of every prefix of a text, by dynamic programming over its words.

Byte-pair encodings are built by merges in a fixed order, so that two tokens can stand side
by side if and only if undoing their merges, newest first, never meets a border that an
earlier merge would have closed; and a row of tokens is the encoding of what it spells if
all its neighbours can stand so. The last token of a prefix is therefore the one token
that ends there and can follow the last token of the prefix before it, and one pass over a
word finds count and last token of all its prefixes. As the tokenizer marks the end of a
word, each prefix is counted twice: as a beginning (the table that longer prefixes build
on) and as a word that ends there.

Stored. For each text one signed number a byte: how the token count changes from the
prefix before. Their running sum up to a byte is the number of tokens that the library
gives for the text cut behind it. Places inside a character, or between a letter and
combining marks after it, are no places to cut: the change is at the first byte, those
after it have zero and so the count up to the character's end. The numbers are as narrow
as they all fit (8, 16 or 32 bits; the width follows from their number), so truncation to
a budget, budget checks and counts of any part need this column only and never the
tokenizer.

White space only parts words for this kind of tokenizer, so texts are cut at ASCII blanks
and the changes of a word are found once and remembered within bounds. Words of letters
take the direct way; all others go through the library's normalizer and splitting first.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.rans import LETTERS, byte_letters
from lakeloom.llm.shared import (
    Remembered,
    batches_of,
    gathered,
    on_worker,
    over_batches,
    record_batch,
    session,
)

WORD_END = "</w>"
NEVER = 1 << 60
BATCH_BYTES = 8 << 20
REMEMBERED = 64 << 20  # bytes of words in a Python worker
PAIRS = 1 << 18  # remembered answers on neighbours
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
# Behind letters these are a part of their own; not the signs of contractions and specials.
TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
TAIL_PATTERN = f"^.*?([{re.escape(TAIL)}]*)$"
WIDTHS = (np.int8, np.int16, np.int32)


class Merges:
    """Which tokens can be neighbours, and the prefix tables of words."""

    def __init__(self, definition: str):
        import json

        model = json.loads(definition)["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("prefix counts need a plain byte-pair encoding")
        if model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("prefix counts need a tokenizer that marks the ends of words")
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for i, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[a, b] = i
            if a + b in self.parts:
                raise ValueError("two merges make one token")
            self.parts[a + b] = a, b
        self.made = {t: self.rank[p] for t, p in self.parts.items()}
        tokens = [t for t in model["vocab"] if t in self.made or len(t.removesuffix(WORD_END)) == 1]
        middle = {t for t in tokens if not t.endswith(WORD_END)}
        last = {t.removesuffix(WORD_END): t for t in tokens if t.endswith(WORD_END)}
        # What a piece of a word can be: a token within the word, a token at its end.
        self.pieces = {p: (p if p in middle else None, last.get(p)) for p in middle | set(last)}
        self.longest = max(map(len, self.pieces))
        self.known: dict[tuple[str, str], bool] = {}

    def neighbours(self, a: str, b: str) -> bool:
        if len(self.known) >= PAIRS:
            self.known.clear()
        found = self.known[a, b] = self._neighbours(a, b)
        return found

    def _neighbours(self, a: str, b: str) -> bool:
        """Undoes merges on both sides of the border, newest first.

        At each step both outer pieces existed until the merge undone last on their side;
        a merge of the two before that would have closed the border. Of equal merges the
        left one is done first.
        """
        until_a = until_b = NEVER
        while True:
            joined = self.rank.get((a, b), NEVER)
            if joined < until_a and joined <= until_b and joined < NEVER:
                return False
            made_a, made_b = self.made.get(a, -1), self.made.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                until_a, a = made_a, self.parts[a][1]
            else:
                until_b, b = made_b, self.parts[b][0]

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of each beginning of a word (in letters of the byte alphabet), as a word."""
        pieces, known, longest = self.pieces, self.known, self.longest
        counts, last, ended = [0], [""], []
        for end in range(1, len(word) + 1):
            open_ = closed = 0
            for start in range(end - longest if end > longest else 0, end):
                kinds = pieces.get(word[start:end])
                if kinds is None:
                    continue
                piece, whole = kinds
                before = last[start]
                if not open_ and piece is not None:
                    fits = known.get((before, piece)) if before else True
                    if fits or fits is None and self.neighbours(before, piece):
                        open_, token = counts[start] + 1, piece
                if not closed and whole is not None:
                    fits = known.get((before, whole)) if before else True
                    if fits or fits is None and self.neighbours(before, whole):
                        closed = counts[start] + 1
                if open_ and closed:
                    break
            else:
                raise ValueError(f"no encoding of {word[:end]!r}")
            counts.append(open_)
            last.append(token)
            ended.append(closed)
        return ended


class PrefixTokenizer:
    """Changes of the token count along texts."""

    def __init__(self, definition: str):
        self.full = Tokenizer.from_str(definition)
        self.merges = Merges(definition)
        added = self.full.get_added_tokens_decoder().values()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("added tokens must be plain strings")
        self.specials = [t.content for t in added]
        self.letters = byte_letters()
        self.words = Remembered(self._changes, REMEMBERED)

    def _changes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        lengths = np.empty(len(words), np.int64)
        for i, word in enumerate(words):
            before = len(flat)
            flat += self.word(word)
            lengths[i] = len(flat) - before
        return np.array(flat, np.int32), lengths

    def word(self, word: str) -> list[int]:
        """Changes of the count at each byte of a word without ASCII blanks."""
        if LETTERS.fullmatch(word):
            low = word.lower()
            if low.isascii():
                counts = self.merges.prefix_counts(low)
                return [b - a for a, b in zip([0, *counts], counts)]
            # Letters whose lower case is as long and one letter; no marks can follow here.
            if len(low) == len(word) and all(c < "\u0250" for c in low):
                counts = self.merges.prefix_counts(low.translate(self.letters))
                changes, at, before = [], 0, 0
                for c in low:
                    at += 1 if c < "\x80" else 2
                    changes.append(counts[at - 1] - before)
                    if c >= "\x80":
                        changes.append(0)
                    before = counts[at - 1]
                return changes
        changes, start, before = [0] * len(word.encode()), 0, 0
        for end, count in self._any(word):
            changes[start] = count - before
            start, before = end, count
        return changes

    def _any(self, word: str) -> list[tuple[int, int]]:
        """(places in bytes where a word can be cut, tokens of the part before)."""
        ends, counts, base, byte = [], [], 0, 0
        at = 0
        while at < len(word):
            found = [(p, -len(s), s) for s in self.specials if (p := word.find(s, at)) >= 0]
            place, _, special = min(found, default=(len(word), 0, ""))
            plain = word[at:place]
            # Cut inside the special string, what is there of it is ordinary text.
            part_ends, part_counts = self._plain(plain + special[:-1])
            ends += [byte + e for e in part_ends]
            counts += [base + c for c in part_counts]
            byte += len((plain + special).encode())
            if special:
                before = dict(zip(part_ends, part_counts)).get(len(plain.encode()))
                if before is None and plain:
                    before = self._plain(plain)[1][-1]
                base += (before or 0) + 1
                ends.append(byte)
                counts.append(base)
            at = place + len(special)
        return list(zip(ends, counts))

    def _plain(self, text: str) -> tuple[list[int], list[int]]:
        """The same for text without special strings."""
        parts = clusters(text)
        normal = [self.full.normalizer.normalize_str(p) for p in parts]
        # The normalizer makes one blank of a run of blanks.
        normal = ["" if a == b == " " else b for a, b in zip(["", *normal], normal)]
        if "".join(normal) != self.full.normalizer.normalize_str(text):
            parts, normal = [text], [self.full.normalizer.normalize_str(text)]
        at_byte = list(accumulate(len(p.encode()) for p in parts))
        at = list(accumulate(map(len, normal)))
        whole = "".join(normal)
        split = self.full.pre_tokenizer.pre_tokenize_str(whole)
        # The library's splits are in letters of the byte alphabet, their offsets in characters.
        done = [0] * (len(whole) + 1)  # tokens of the text cut after so many characters
        total, reached = 0, 0
        for letters, (a, b) in split:
            for i in range(reached, a + 1):
                done[i] = total
            piece = whole[a:b]
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
                # A contraction: cut before its end it is no contraction yet.
                for i in range(1, b - a):
                    done[a + i] = total + self._tokens(piece[:i])
                done[b] = total + self.merges.prefix_counts(letters)[-1]
            else:
                counts = self.merges.prefix_counts(letters)
                borders = accumulate(len(c.encode()) for c in piece)
                done[a + 1 : b + 1] = [total + counts[i - 1] for i in borders]
            total, reached = done[b], b
        for i in range(reached, len(whole) + 1):
            done[i] = total
        return at_byte, [done[i] for i in at]

    def _tokens(self, text: str) -> int:
        parts = self.full.pre_tokenizer.pre_tokenize_str(text)
        return sum(self.merges.prefix_counts(letters)[-1] for letters, _ in parts)

    def changes(self, texts: pa.Array) -> list[np.ndarray]:
        """Of each text (null: empty), one number a byte."""
        texts = pc.fill_null(texts, "")
        lengths = pc.binary_length(texts).to_numpy()
        coded = pc.ascii_split_whitespace(texts).flatten().dictionary_encode()
        words = coded.dictionary
        # Words of letters are looked up without plain punctuation behind them, which
        # starts anew there; words of anything else are looked up whole.
        low = pc.ascii_lower(words)
        stem = pc.utf8_rtrim(low, TAIL)
        letters = pc.match_substring_regex(stem, f"^{LETTERS.pattern}$")
        tail_bytes = pc.subtract(pc.binary_length(low), pc.binary_length(stem))
        tail = pc.if_else(letters, pc.replace_substring_regex(low, TAIL_PATTERN, r"\1"), "")
        tail = pc.if_else(pc.greater(tail_bytes, 0), tail, "")
        stem = pc.if_else(letters, stem, words)
        both = pa.concat_arrays([stem, tail]).dictionary_encode()
        place = self.words.places(both.dictionary.to_numpy(zero_copy_only=False))
        place = place[both.indices.to_numpy()].reshape(2, -1).T  # of stem and tail
        found = self.words.ids(place[coded.indices.to_numpy()].ravel())
        data = np.frombuffer(b"".join(texts.cast(pa.large_binary()).to_pylist()), np.uint8)
        result = np.zeros(len(data), np.int32)
        result[~BLANKS[data]] = found
        return np.split(result, np.cumsum(lengths)[:-1]) if len(lengths) else []


JOINED = {(0x1160, 0x11FF), (0xD7B0, 0xD7FF)}  # Hangul vowels and finals join what is before


def clusters(text: str) -> list[str]:
    """Letters with all that follows and may be composed with them."""
    found: list[str] = []
    for c in text:
        code = ord(c)
        joins = code >= 0x300 and (
            unicodedata.category(c)[0] == "M" or any(a <= code <= b for a, b in JOINED)
        )
        if joins and found and not found[-1].isspace():
            found[-1] += c
        else:
            found.append(c)
    return found


def narrow(changes: np.ndarray) -> bytes:
    """The numbers in the narrowest width that holds them all."""
    low, high = int(changes.min(initial=0)), int(changes.max(initial=0))
    kind = next(k for k in WIDTHS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return changes.astype(kind).tobytes()


def running(changes: bytes, n_bytes: int) -> np.ndarray:
    """Token counts of the prefixes of 1 to ``n_bytes`` bytes from the stored column."""
    kind = {1: np.int8, 2: np.int16, 4: np.int32}[len(changes) // n_bytes] if n_bytes else np.int8
    return np.cumsum(np.frombuffer(changes, kind), dtype=np.int64)


def prefix_table(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, changes`` of every row, in their order.

    ``n_tokens`` is the count of the whole text, the last of the prefixes. Null, empty and
    blank texts have none; repeated rows and null ids stay; other columns are ignored.
    Texts are neither cut nor sampled; one text is held at a time beside a batch.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    name = f"prefixes_{zlib.crc32(definition.encode())}"

    def run(batches):
        tokenizer = on_worker(name, lambda: PrefixTokenizer(definition))
        for batch in gathered(batches, "text", BATCH_BYTES):
            found = tokenizer.changes(batch.column("text"))
            yield record_batch(
                {
                    "doc_id": (batch.column("doc_id"), pa.int64()),
                    "n_bytes": ([len(f) for f in found], pa.int64()),
                    "n_tokens": ([int(f.sum(dtype=np.int64)) for f in found], pa.int64()),
                    "changes": ([narrow(f) for f in found], pa.binary()),
                }
            )

    return over_batches(rows, run, "doc_id bigint, n_bytes bigint, n_tokens bigint, changes binary")


def within(table: DataFrame, budget: int) -> DataFrame:
    """The prefix table's rows with ``cut_bytes`` and ``cut_tokens`` in place of ``changes``.

    ``cut_bytes`` is the length of the longest prefix of at most ``budget`` tokens and
    ``cut_tokens`` its count. (A longer prefix can have fewer tokens; all are looked at.)
    """
    session(table)

    def run(batches):
        for batch in batches_of(batches):
            cuts, tokens = [], []
            for n, changes in zip(
                batch.column("n_bytes").to_pylist(), batch.column("changes").to_pylist()
            ):
                counts = running(changes, n)
                fits = np.flatnonzero(counts <= budget)
                # Bytes of a character share its count, so the last that fits ends one.
                at = int(fits[-1]) if len(fits) else -1
                cuts.append(at + 1)
                tokens.append(int(counts[at]) if at >= 0 else 0)
            yield record_batch(
                {
                    "doc_id": (batch.column("doc_id"), pa.int64()),
                    "n_bytes": (batch.column("n_bytes"), pa.int64()),
                    "n_tokens": (batch.column("n_tokens"), pa.int64()),
                    "cut_bytes": (cuts, pa.int64()),
                    "cut_tokens": (tokens, pa.int64()),
                }
            )

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, cut_bytes bigint, cut_tokens bigint"
    return over_batches(table, run, schema)


def over_limit(limit: int) -> Column:
    return F.col("n_tokens") > F.lit(limit)
