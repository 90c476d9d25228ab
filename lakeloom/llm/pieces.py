"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Method. A text is turned into marked words: every blank becomes the whitespace marker,
and one marker is put in front. The pieces' UTF-8 bytes are held in a double-array trie;
Viterbi finds the segmentation with the largest sum of log scores. A character that no
piece covers is written as its bytes' pieces (byte fallback). Decoding joins the pieces,
turns markers into blanks and drops the first one. A marker character in the text itself
goes through its bytes, so that decoding always gives the text back.

No piece has a marker after another character or holds a line break (checked when the
pieces are loaded), so the best segmentation of a text is that of its words one by one.
Each task segments the distinct words of a batch together, all words of a length in step,
and remembers them for later batches up to a fixed number.

Scores. A piece file without probabilities (its scores are ranks) gets Zipf's law:
``log(1 / (rank + 1))``, normalised. Among equal sums the longer last piece wins.
"""

from __future__ import annotations

import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.shared import Remembered, batches_of, on_worker, over_batches, texts

MARKER = "▁"
MARKER_BYTES = MARKER.encode()
UNKNOWN_PENALTY = 10.0  # below the worst piece, for a character in byte fallback
TEXT_AT_ONCE = 2 << 20  # bytes
REMEMBERED_BYTES = 64 << 20
LONG_WORD = 96  # bytes; longer words are segmented one by one

# A word: blanks and what follows up to the next blank or line break. A line break, or a
# marker character, stands alone.
WORD = re.compile(rb" *(?:(?!\xe2\x96\x81)[^ \n])+| +|\n|\xe2\x96\x81")


class Pieces:
    """The pieces of a model file: bytes, log scores, trie, and the bytes' own pieces."""

    def __init__(self, model: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(processor.vocab_size())
        self.bytes_of: list[bytes] = []
        self.byte_id = np.zeros(256, np.int32)
        normal: list[int] = []
        for i in ids:
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                self.bytes_of.append(b"")
            else:
                normal.append(i)
                self.bytes_of.append(piece.encode())
                if MARKER in piece.lstrip(MARKER) or "\n" in piece:
                    raise ValueError(f"piece {i} crosses words")
        self.byte_pieces = frozenset(self.byte_id.tolist())
        own = np.array([processor.get_score(i) for i in normal])
        if (own <= 0).all() and own.min() > -1000:  # log probabilities
            scores = own
        else:
            order = np.argsort(-own, kind="stable")
            weights = np.empty(len(own))
            weights[order] = 1.0 / np.arange(1, len(own) + 1)
            scores = np.log(weights / weights.sum())
        self.unknown = float(scores.min()) - UNKNOWN_PENALTY
        self.score = np.full(len(self.bytes_of), -np.inf)
        self.score[normal] = scores
        self.longest = max(len(self.bytes_of[i]) for i in normal)
        self._build({self.bytes_of[i]: i for i in normal})
        # Decoded form of each piece: markers are blanks.
        self.text_of = [
            b if i in self.byte_pieces else b.replace(MARKER_BYTES, b" ")
            for i, b in enumerate(self.bytes_of)
        ]

    def _build(self, keys: dict[bytes, int]) -> None:
        """Double array: from state s by byte c to ``base[s] + c + 1``, if ``check`` says s."""
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, piece in keys.items():
            node = 0
            for c in key:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = piece
        size = 2 * len(children) + 512
        base, check, held = np.zeros(size, np.int32), np.full(size, -1, np.int32), [-1] * size
        used = np.zeros(size, bool)
        used[:257] = True  # so that the first free place can take a child by any byte
        held[0] = value[0]
        state_of, free, wide = {0: 0}, 257, 0
        for node in range(len(children)):  # parents come before their children
            if not children[node]:
                continue
            codes = np.array(sorted(children[node]), np.int32)
            state = state_of[node]
            while used[free]:
                free += 1
            # An only child takes the first free place, brothers are put further on.
            at = max(free - 1 - int(codes[0]), wide if len(codes) > 1 else 0)
            while at + 258 > len(used) or used[at + 1 + codes].any():
                if at + 258 > len(used):
                    used = np.concatenate([used, np.zeros(size, bool)])
                    base = np.concatenate([base, np.zeros(size, np.int32)])
                    check = np.concatenate([check, np.full(size, -1, np.int32)])
                    held += [-1] * size
                else:
                    at += 1
            wide = at if len(codes) > 1 else wide
            base[state] = at
            for c in codes.tolist():
                child = children[node][c]
                used[at + 1 + c] = True
                check[at + 1 + c] = state
                held[at + 1 + c] = value[child]
                state_of[child] = at + 1 + c
        # Room for a step from any state by any byte.
        room = np.zeros(258, np.int32)
        self.base = np.concatenate([base, room])
        self.check = np.concatenate([check, room - 1])
        self.piece_at = np.concatenate([np.array(held, np.int32), room - 1])

    def segment(self, words: list[bytes]) -> list[list[int]]:
        """Piece ids of each word (given with markers); all words of a length in step."""
        result: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes).tolist():
            chosen = np.flatnonzero(sizes == size)
            if size > LONG_WORD:
                for i in chosen.tolist():
                    result[i] = self.segment_long(words[i])
                continue
            for part in np.array_split(chosen, -(-len(chosen) // 20_000)):
                matrix = np.frombuffer(b"".join([words[i] for i in part]), np.uint8)
                for i, ids in zip(part.tolist(), self._in_step(matrix.reshape(-1, size))):
                    result[i] = ids
        return result

    def _in_step(self, matrix: np.ndarray) -> list[list[int]]:
        n, size = matrix.shape
        code = matrix.astype(np.int32) + 1
        starts = np.c_[(matrix & 0xC0) != 0x80, np.ones(n, bool)]  # a character begins, or the end
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        came = np.zeros((size + 1, n), np.int32)
        piece = np.full((size + 1, n), -1, np.int32)
        for i in range(size):
            rows = np.flatnonzero(starts[:, i])
            if not len(rows):
                continue
            state, live, open_ = np.zeros(len(rows), np.int32), rows, rows
            for k in range(i, min(size, i + self.longest)):
                if len(live):
                    step = self.base[state] + code[live, k]
                    ok = self.check[step] == state
                    live, state = live[ok], step[ok]
                    found = self.piece_at[state]
                    ends = found >= 0
                    if ends.any():
                        self._relax(best, came, piece, live[ends], i, k + 1, found[ends])
                if len(open_):
                    ends = starts[open_, k + 1]
                    done, open_ = open_[ends], open_[~ends]
                    if len(done):
                        self._relax(best, came, piece, done, i, k + 1, None)
                if not len(live) and not len(open_):
                    break
        ids: list[list[int]] = []
        came_l, piece_l = came.T.tolist(), piece.T.tolist()
        for r in range(n):
            out, end = [], size
            while end:
                begin, p = came_l[r][end], piece_l[r][end]
                if p >= 0:
                    out.append(p)
                else:
                    out.extend(self.byte_id[matrix[r, begin:end][::-1]].tolist())
                end = begin
            out.reverse()
            ids.append(out)
        return ids

    def _relax(self, best, came, piece, rows, i, end, found) -> None:
        score = best[i, rows] + (self.unknown if found is None else self.score[found])
        better = score > best[end, rows]
        rows = rows[better]
        best[end, rows] = score[better]
        came[end, rows] = i
        piece[end, rows] = -1 if found is None else found[better]

    def segment_long(self, word: bytes) -> list[int]:
        """The same for one word of any length."""
        base, check, piece_at, score = self.base, self.check, self.piece_at, self.score
        size = len(word)
        best, came, piece = [-np.inf] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        best[0] = 0.0
        for i in range(size):
            if word[i] & 0xC0 == 0x80:
                continue
            state, char_end = 0, i + 1
            while char_end < size and word[char_end] & 0xC0 == 0x80:
                char_end += 1
            here, live = best[i], True
            for k in range(i, min(size, i + self.longest)):
                step = base[state] + word[k] + 1
                live = check[step] == state
                if live:
                    state = step
                    p = piece_at[state]
                    if p >= 0 and here + score[p] > best[k + 1]:
                        best[k + 1], came[k + 1], piece[k + 1] = here + score[p], i, int(p)
                if k + 1 == char_end and here + self.unknown > best[k + 1]:
                    best[k + 1], came[k + 1], piece[k + 1] = here + self.unknown, i, -1
                if not live and k + 1 >= char_end:
                    break
        out, end = [], size
        while end:
            if piece[end] >= 0:
                out.append(piece[end])
            else:
                out.extend(self.byte_id[list(word[came[end] : end][::-1])].tolist())
            end = came[end]
        return out[::-1]


class Encoder:
    """Encodes and decodes texts; remembers the segmentation of words seen in a task.

    The pieces stay on the Python worker for later tasks; the words, which take most of the
    memory, go with the task, so that other operators find the worker as small as before.
    """

    def __init__(self, model: bytes):
        self.pieces = on_worker(f"pieces_{zlib.crc32(model)}", lambda: Pieces(model))
        self.words = Remembered(self._segment, REMEMBERED_BYTES)

    def _segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.pieces.segment([w.replace(b" ", MARKER_BYTES) for w in words])
        alone = {b"\n": [10], MARKER_BYTES: list(MARKER_BYTES)}
        for i, word in enumerate(words):
            if word in alone:
                found[i] = self.pieces.byte_id[alone[word]].tolist()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, lengths.sum()), lengths

    def encode(self, batch: list[bytes]) -> list[np.ndarray]:
        """Piece ids of each text; an empty text has none."""
        results: list[np.ndarray] = []
        some, size = [], 0
        for text in batch:
            some.append(text)
            size += len(text)
            if size > TEXT_AT_ONCE:
                results += self._encode(some)
                some, size = [], 0
        return results + self._encode(some)

    def _encode(self, batch: list[bytes]) -> list[np.ndarray]:
        split = [WORD.findall(b" " + t) if t else [] for t in batch]
        distinct = list(set().union(*split))
        place = dict(zip(distinct, self.words.places(distinct).tolist()))
        return [
            self.words.ids(np.fromiter(map(place.__getitem__, found), np.int64, len(found)))
            for found in split
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text; the marker put in front is dropped."""
        return b"".join(map(self.pieces.text_of.__getitem__, ids.tolist()))[1:]


def model_bytes(path: str) -> bytes:
    """A piece file has less than a megabyte; it travels with the tasks."""
    return Path(path).read_bytes()


def encode(
    docs: DataFrame, model: bytes, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """The kept columns (default ``doc_id``) and ``ids`` of every row.

    A null text has null ids, an empty one none. Texts are encoded whole, whatever their
    length; rows are judged each for itself, so repeated rows stay; other columns are
    ignored.
    """
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep or ["doc_id"]], F.col(text).cast("string").alias("_text")
    )

    def run(batches):
        encoder = Encoder(model)
        for batch in batches_of(batches):
            there = [v.as_py() for v in batch.column("_text").is_valid()]
            found = encoder.encode(texts(batch, "_text"))
            sizes = np.array([len(f) for f in found], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            flat = pa.array(np.concatenate([*found, np.empty(0, np.int32)]), pa.int32())
            ids = pa.ListArray.from_arrays(
                offsets, flat, mask=pa.array([not t for t in there], pa.bool_())
            )
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, ids], names=[n for n in batch.schema.names if n != "_text"] + ["ids"]
            )

    return over_batches(rows, run, rows.drop("_text").schema.add("ids", T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, model: bytes, keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``text`` of every row with ``ids``; null ids are a null text."""
    rows = encoded.select(*[F.col(f"`{c}`") for c in keep or ["doc_id"]], F.col("ids").alias("_ids"))

    def run(batches):
        text_of = Pieces(model).text_of
        for batch in batches_of(batches):
            values = [
                None if v is None else b"".join([text_of[i] for i in v])[1:].decode()
                for v in batch.column("_ids").to_pylist()
            ]
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "_ids"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(values, pa.string())],
                names=[n for n in batch.schema.names if n != "_ids"] + ["text"],
            )

    return over_batches(rows, run, rows.drop("_ids").schema.add("text", "string"))


def round_trip(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """Digest of encoding and decoding every row, in one pass.

    Returns ``doc_id, n_pieces, n_bytes`` (pieces of byte fallback), ``score`` (sum of the
    pieces' log scores; byte fallback counts as the unknown score a byte), ``ids_crc32`` (of
    the ids as little-endian 32-bit numbers) and ``same`` (decoding gives the text back).
    A null text counts as empty.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("_text")
    )

    def run(batches):
        encoder = Encoder(model)
        pieces = encoder.pieces
        is_byte = np.zeros(len(pieces.bytes_of), bool)
        is_byte[pieces.byte_id] = True
        score = np.where(is_byte, pieces.unknown, pieces.score)
        for batch in batches_of(batches):
            values = texts(batch, "_text")
            found = encoder.encode(values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([int(is_byte[f].sum()) for f in found], pa.int64()),
                    pa.array([float(score[f].sum()) for f in found], pa.float64()),
                    pa.array([zlib.crc32(f.astype("<i4").tobytes()) for f in found], pa.int64()),
                    pa.array([encoder.decode(f) == t for f, t in zip(found, values)], pa.bool_()),
                ],
                names=["doc_id", "n_pieces", "n_bytes", "score", "ids_crc32", "same"],
            )

    return over_batches(
        rows,
        run,
        "doc_id bigint, n_pieces bigint, n_bytes bigint, score double, ids_crc32 bigint, "
        "same boolean",
    )
