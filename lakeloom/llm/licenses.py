"""License scans: Aho-Corasick for tags and notice phrases, shunting-yard for expressions.

Method. A text's words (ASCII lower case; letters, digits and everything beyond ASCII) are
joined by single blanks, and one automaton finds all places of all phrases in one pass.
Where it finds an identifier tag, the licence expression after the tag is read from the
text itself: a shunting-yard parser (``with`` binds before ``and`` before ``or``) turns it
into postfix order, which is evaluated to a degree of openness: ``or`` offers the more open
side, ``and`` demands the less open one, ``with`` adds an exception's permission.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import batches_of, over_batches, texts, word_runs

# Letters to lower case, all other ASCII but digits to blanks; bytes beyond ASCII are words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
OWN_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "licensed under the apache license": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons": "creative-commons",
    "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
}
TAG = "spdx license identifier"
TAG_IN_TEXT = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)

# Openness of a licence by the beginning of its identifier; the first that fits counts.
OPENNESS = [
    ("cc-by-nc", 0.2), ("cc-by-nd", 0.4), ("cc-by-sa", 0.6), ("cc-by", 0.9), ("cc0", 1.0),
    ("agpl", 0.2), ("lgpl", 0.6), ("gpl", 0.3), ("mpl", 0.6), ("epl", 0.6), ("cddl", 0.6),
    ("mit", 1.0), ("apache", 1.0), ("bsd", 1.0), ("isc", 1.0), ("zlib", 1.0),
    ("unlicense", 1.0), ("bsl", 1.0), ("psf", 1.0), ("python", 1.0),
]
EXCEPTION = 0.3  # what an exception adds
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")


def postfix(expression: str) -> list[str] | None:
    """The expression's identifiers and operators in postfix order, lower-cased.

    Reads as far as an expression can go, so words of a running text may follow. None if
    there is no expression there, or one that misses an operand or a bracket.
    """
    output: list[str] = []
    stack: list[str] = []
    operand_next, depth = True, 0
    for match in TOKEN.finditer(expression):
        token = match.group().lower().rstrip(".:")
        if expression[: match.start()].rstrip(" \t")[-2:] in ("*/", "->"):
            break  # the comment around the tag ends
        if token == "(" and operand_next:
            stack.append(token)
            depth += 1
        elif token == ")" and not operand_next and depth:
            while stack[-1] != "(":
                output.append(stack.pop())
            stack.pop()
            depth -= 1
        elif token in PRECEDENCE and not operand_next:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                output.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token not in PRECEDENCE and token not in "()" and operand_next:
            output.append(token)
            operand_next = False
        elif operand_next:
            return None
        else:
            break
    if operand_next or depth:
        return None
    return output + stack[::-1]


def openness(identifier: str) -> float:
    return next((value for start, value in OPENNESS if identifier.startswith(start)), 0.0)


def evaluate(order: list[str]) -> tuple[float, set[str]]:
    """(openness, identifiers) of an expression in postfix order."""
    stack: list[float] = []
    names: set[str] = set()
    exceptions = {order[i - 1] for i, token in enumerate(order) if token == "with"}
    for token in order:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append(min(1.0, left + EXCEPTION))
            else:
                stack.append(max(left, right) if token == "or" else min(left, right))
        else:
            stack.append(openness(token))
            if token not in exceptions:
                names.add(token)
    return stack[0], names


def automaton(phrases: dict[str, tuple[str, bool]]) -> ahocorasick.Automaton:
    """Finds `` phrase `` in words joined by blanks; neighbours may share a blank."""
    found = ahocorasick.Automaton()
    for phrase, (label, base) in phrases.items():
        key = f" {phrase} "
        found.add_word(key, (len(key), phrase.count(" ") + 1, label, base))
    found.make_automaton()
    return found


def scan(text: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """The columns of ``licenses`` for one text."""
    runs = [(len(w), b" ".join(w)) for w in word_runs(text.translate(WORD_BYTES))]
    line = b" ".join([b"", *[run for _, run in runs], b""]).decode("latin-1")
    n_base, first, last, counted, place = 0, None, None, 0, -1
    base_labels, labels, score, degrees, tagged = set(), set(), 0.0, [], False
    starts = []
    for end, (size, n, label, base) in phrases.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        score = max(score, 1 - 0.5**n)
        if base:
            base_labels.add(label)
            starts.append(end - size + 1)
    for start in sorted(starts):
        place += line.count(" ", counted, start + 1)
        counted = start + 1
        n_base += 1
        first = place if first is None else first
        last = place
    if tagged:
        for match in TAG_IN_TEXT.finditer(text):
            order = postfix(match[1].decode("utf-8", "replace"))
            if order is None:
                score = max(score, 0.5)
                continue
            degree, names = evaluate(order)
            degrees.append(degree)
            labels |= names
            score = 1.0
    return (
        sum(n for n, _ in runs),
        n_base,
        first,
        last,
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        float(score),
        min(degrees) if degrees else None,
    )


def licenses(
    docs: DataFrame,
    base: dict[str, str] | None = None,
    own: dict[str, str] | None = None,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """License findings of every row.

    Returns ``doc_id, n_words``; of the base phrases ``n_base`` (all places, also
    overlapping ones), ``first_word`` and ``last_word`` (their first and last start, words
    from 0; else null) and ``base_labels``; ``labels`` (also of the own phrases and of valid
    tags); ``score``, the strength of the best evidence (1 for a valid tag, 0.5 for a broken
    one, ``1 - 2^-words`` for a phrase, 0 for none); and ``openness``, the least open of the
    valid tags (null without one). A null text is empty, no labels are an empty string;
    texts are read whole; repeated rows stay repeated; other columns are ignored.
    """
    phrases: dict[str, tuple[str | None, bool]] = {TAG: (None, False)}
    phrases |= {p: (label, False) for p, label in (OWN_PHRASES if own is None else own).items()}
    phrases |= {p: (label, True) for p, label in (BASE_PHRASES if base is None else base).items()}
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    columns = {
        "n_words": pa.int64(),
        "n_base": pa.int64(),
        "first_word": pa.int64(),
        "last_word": pa.int64(),
        "base_labels": pa.string(),
        "labels": pa.string(),
        "score": pa.float64(),
        "openness": pa.float64(),
    }

    def run(batches):
        found = automaton(phrases)
        for batch in batches_of(batches):
            results = zip(*[scan(t, found) for t in texts(batch, "text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(list(r), kind) for r, kind in zip(results, columns.values())],
                names=["doc_id", *columns],
            )

    return over_batches(
        rows,
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, openness double",
    )
