"""Words of whole Arrow text columns, cut by classes of bytes with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lakeloom.llm.shared import ASCII_LOWER

IN_WORD, GAP, BREAK = 0, 1, 2
LOWER = np.frombuffer(ASCII_LOWER, np.uint8)
AT_ONCE = 4 << 20  # bytes looked at together; a longer text is cut at a border of words


def kinds(inside, breaks: bytes = b"") -> np.ndarray:
    """The class of each byte: in a word, a gap, or a gap that ends a piece."""
    found = np.full(256, GAP, np.uint8)
    found[list(inside)] = IN_WORD
    found[list(breaks)] = BREAK
    return found


@dataclass
class Words:
    """Words in order: a code and a piece's number each; ``rows`` names their text.

    Words of one piece stand in one text with no break between them.
    """

    codes: np.ndarray
    pieces: np.ndarray
    rows: np.ndarray
    dictionary: pa.Array  # binary, the word of each code


def words_of(values: pa.Array, kind: np.ndarray) -> Words:
    """The lower-cased (A-Z only) words of a string column; a null text has none."""
    values = values.fill_null("")
    wide = pa.types.is_large_string(values.type)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[values.offset : values.offset + len(values) + 1].astype(np.int64)
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    borders = offsets - offsets[0]
    found, pieces, rows, broken = [], [], [], 0
    for a, b in _chunks(data, borders, kind):
        words, starts, breaks, broken = _cut(data[a:b], borders - a, kind, broken)
        row = np.searchsorted(borders, starts + a, side="right") - 1
        found.append(words)
        rows.append(row)
        pieces.append(breaks + row)
    none = pa.array([], pa.large_binary())
    coded = pa.concat_arrays([*found, none]).dictionary_encode()
    empty = np.empty(0, np.int64)
    return Words(
        coded.indices.to_numpy(),
        np.concatenate([*pieces, empty]),
        np.concatenate([*rows, empty]),
        coded.dictionary,
    )


def _chunks(data: np.ndarray, borders: np.ndarray, kind: np.ndarray):
    """Ranges of about ``AT_ONCE`` bytes that end at a text's end or beside a gap."""
    at = 0
    while at < len(data):
        end = at + AT_ONCE
        if end < len(data):
            stop = int(borders[np.searchsorted(borders, end)])  # the text's end
            while end < stop:
                gap = np.flatnonzero(kind[data[end : min(end + 4096, stop)]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(end + 4096, stop)
        end = min(end, len(data))
        yield at, end
        at = end


def _cut(data: np.ndarray, borders: np.ndarray, kind: np.ndarray, broken: int):
    """(words, their starts, breaks before each, breaks up to the end)."""
    kind_of = kind[data]
    inside = kind_of == IN_WORD
    joined = np.zeros(len(data) + 1, bool)  # a word goes on over this place
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[borders[(borders >= 0) & (borders <= len(data))]] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    at = np.flatnonzero(kind_of == BREAK)
    breaks = broken + np.searchsorted(at, starts)
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    letters = LOWER[data[inside]]
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    return words, starts, breaks, broken + len(at)
