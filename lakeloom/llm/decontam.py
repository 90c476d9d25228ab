"""Benchmark decontamination by the q-gram lemma, diagonal bands and banded alignment.

Method. Texts are lower-cased (A-Z) and runs of white space become one blank. Benchmark
items are cut into windows that start as many bytes apart as a window may have edits, so
that an excerpt as long as a window is at most half of its edits away from one, wherever
it starts. A region of a document that is within ``k`` edits
of a window of ``m`` bytes shares at least ``m + 1 - q (k + 1)`` of its q-grams with it
(the q-gram lemma), and the diagonals of those q-grams differ by at most ``k``. So shared
q-grams are counted in bands of diagonals ``2 (k + 1)`` wide that overlap by half; one
band holds all of them. Bands that reach the bound are verified by an alignment within
the band.

Scale. Documents stream past an index of the benchmark; nothing of them is shuffled. The
index is built and sent to the tasks in slices of bounded size (a usual benchmark is one).
After ``SLICES_A_STAGE`` of them the findings so far are written, so that a task never
holds more indexes at a time, however large the benchmark is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import (
    ASCII_LOWER,
    batches_of,
    over_batches,
    ragged,
    record_batch,
    session,
    texts,
)
from lakeloom.session import materialize

Q = 8  # one 64-bit word
WINDOW_BYTES = 80
EDIT_RATE = 0.1
SLICE_BYTES = 1 << 19  # benchmark text in one index; its size in memory is some 200 times that
SLICES_A_STAGE = 2  # indexes that a task holds; their findings are written before the next
SCAN_BYTES = 1 << 20  # text scanned at once, and the length of a piece of a longer text
TABLE_BITS = 22
BAND_BITS = 20
MIXER = np.uint64(0x9E3779B97F4A7C15)


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(ASCII_LOWER).split())


def edits_allowed(length: int, rate: float) -> int:
    """The edit budget; the lemma's bound stays at least one shared q-gram."""
    return max(0, min(int(rate * length), length // Q - 1))


def windows_of(item: bytes, size: int, step: int) -> list[bytes]:
    """Windows that start every ``step`` bytes; the last ends with the item."""
    if len(item) <= size:
        return [item]
    starts = [*range(0, len(item) - size, step), len(item) - size]
    return [item[s : s + size] for s in starts]


def grams(text: bytes) -> np.ndarray:
    """The q-gram at each place, as one number."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    found = np.empty(n, np.uint64)
    for shift in range(min(Q, n)):
        found[shift::Q] = np.frombuffer(text, "<u8", (n - shift + Q - 1) // Q, shift)
    return found


def slot(values: np.ndarray) -> np.ndarray:
    return ((values * MIXER) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def band_slot(keys: np.ndarray) -> np.ndarray:
    return slot(keys.view(np.uint64)) >> (TABLE_BITS - BAND_BITS)


def hashed_counts(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, or more where keys share a slot."""
    slots = band_slot(keys)
    return np.bincount(slots, minlength=1 << BAND_BITS)[slots]


class Index:
    """Windows of benchmark items and the places of the items' q-grams.

    All windows of an item are as long and allow as many edits.
    """

    def __init__(self, items: list[tuple[int, bytes]], window: int, rate: float):
        self.windows, owners, self.whole = [], [], {}
        self.step = max(edits_allowed(window, rate), 1)
        kept, first = [], []
        for item_id, text in items:
            text = normal(text).replace(b"\0", b" ")
            if len(text) < Q:
                if text:
                    self.whole.setdefault(text, []).append(item_id)
                continue
            cut = windows_of(text, window, self.step)
            kept.append(text)
            first.append(len(self.windows))
            self.windows += cut
            owners += [item_id] * len(cut)
        self.owners = np.array(owners, np.int64)
        self.edits = np.array([edits_allowed(len(w), rate) for w in self.windows], np.int64)
        lengths = np.array([len(w) for w in self.windows], np.int64)
        self.bound = np.maximum(lengths + 1 - Q * (self.edits + 1), 1)
        # Of each item: its first window, number of windows, their length, the last one's start.
        self.first = np.array(first, np.int64)
        self.n_windows = np.diff(np.r_[self.first, len(self.windows)])
        self.size = lengths[self.first]
        self.last = np.array([len(t) for t in kept], np.int64) - self.size
        found = [grams(t) for t in kept]
        values = np.concatenate(found) if found else np.empty(0, np.uint64)
        item_of = np.repeat(np.arange(len(found)), [len(g) for g in found])
        place = np.concatenate([np.arange(len(g)) for g in found]) if found else item_of
        order = np.argsort(values, kind="stable")
        self.values, self.starts = np.unique(values[order], return_index=True)
        self.counts = np.diff(np.r_[self.starts, len(values)])
        self.item_of, self.place = item_of[order], place[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[slot(self.values)] = True

    def candidates(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first diagonal, shared q-grams) of all bands that reach the bound.

        Diagonals are those of the item. A band that does not reach the bound with the
        q-grams of the whole item does so with no window's, so that only the q-grams of
        bands that do are dealt to the windows that hold them.
        """
        none = np.empty(0, np.int64)
        all_grams = grams(text)
        at = np.flatnonzero(self.table[slot(all_grams)])
        if not len(at) or not len(self.values):
            return none, none, none
        value = all_grams[at]
        k = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        exact = self.values[k] == value
        at, k = at[exact], k[exact]
        if not len(at):
            return none, none, none
        counts = self.counts[k]
        posting = ragged(self.starts[k], counts)
        item, place = self.item_of[posting], self.place[posting]
        diagonal = np.repeat(at, counts) - place
        band = diagonal // (self.edits[self.first[item]] + 1)
        shift = 1 - int(band.min())
        band += shift  # a band holds two steps; each hit is in two bands
        bound = self.bound[self.first[item]]
        item, place, band = self._in_full_bands(item, place, band, bound)
        window, band = self._dealt(item, place, band)
        key = window << 40 | band
        keys = np.concatenate([key, key - 1])
        # Counts by a hash of the band are never too low, so they thin out what is sorted.
        keys = keys[hashed_counts(keys) >= self.bound[keys >> 40]]
        keys, seen = np.unique(keys, return_counts=True)
        enough = seen >= self.bound[keys >> 40]
        window = keys[enough] >> 40
        band = (keys[enough] & ((1 << 40) - 1)) - shift
        owner = np.searchsorted(self.first, window, side="right") - 1
        first = band * (self.edits[window] + 1) + self._start(owner, window)
        return window, first, seen[enough]

    def _in_full_bands(self, item, place, band, bound):
        """The hits in a band that the whole item's q-grams may fill to the bound."""
        key = item << 40 | band
        slots = np.concatenate([band_slot(key), band_slot(key - 1)])
        filled = np.bincount(slots, minlength=1 << BAND_BITS)[slots].reshape(2, -1).max(axis=0)
        kept = filled >= bound
        return item[kept], place[kept], band[kept]

    def _start(self, item: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Where in its item a window starts."""
        number = window - self.first[item]
        return np.where(number == self.n_windows[item] - 1, self.last[item], number * self.step)

    def _dealt(self, item, place, band):
        """(window, band) for each window that holds a hit's q-gram."""
        regular = self.n_windows[item] - 1  # all but the last start at multiples of the step
        low = np.maximum(-((self.size[item] - Q - place) // self.step), 0)
        high = np.minimum(place // self.step, regular - 1)
        n = np.maximum(high - low + 1, 0)
        window = ragged(self.first[item] + low, n)
        last = np.flatnonzero(place >= self.last[item])
        window = np.concatenate([window, self.first[item[last]] + regular[last]])
        return window, np.concatenate([np.repeat(band, n), band[last]])

    def distances(self, text: bytes, window: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Fewest edits of each window within its band; ends of the text are free."""
        best = np.empty(len(window), np.int64)
        data = np.frombuffer(text, np.uint8)
        lengths = np.array([len(self.windows[w]) for w in window], np.int64)
        for size in np.unique(lengths):
            chosen = np.flatnonzero(lengths == size)
            for part in np.array_split(chosen, -(-len(chosen) // 2048)):
                words = np.frombuffer(b"".join(self.windows[w] for w in window[part]), np.uint8)
                best[part] = banded(
                    words.reshape(-1, size), data, first[part], int(self.edits[window[part]].max())
                )
        return best


def banded(words: np.ndarray, data: np.ndarray, first: np.ndarray, edits: int) -> np.ndarray:
    """Edit distance of each word to the best region on diagonals of its band.

    The band is the two steps counted plus ``edits`` on either side, so that every
    alignment within the budget lies inside. Costs are kept by diagonal: a match or
    replacement stays on it, a byte left out of the word moves one to the left, a byte
    put in moves one to the right.
    """
    width, size = 4 * (edits + 1), words.shape[1]
    far = np.int16(1 << 14)
    place = (first - edits)[:, None] + np.arange(width + size)
    within = (place >= 0) & (place < len(data))
    border = (place >= 0) & (place <= len(data))
    region = np.where(within, data[np.clip(place, 0, len(data) - 1)], 0)
    everywhere = bool(within.all())
    steps = np.arange(width, dtype=np.int16)
    cost = np.where(border[:, :width], 0, far).astype(np.int16)
    for i in range(size):
        new = cost + (region[:, i : i + width] != words[:, i, None])
        skip = cost[:, 1:] + np.int16(1)  # a byte of the word has no mate
        if not everywhere:
            new[~within[:, i : i + width]] = far
            skip[~border[:, i : i + width - 1]] = far
        np.minimum(new[:, :-1], skip, out=new[:, :-1])
        # A byte of the text without mate: one diagonal to the right for one edit each.
        cost = np.minimum.accumulate(new - steps, axis=1) + steps
    return cost.min(axis=1).astype(np.int64)


def found_in(index: Index, text: bytes, pieces: int = SCAN_BYTES) -> dict[int, int]:
    """Item id -> fewest edits, for all items with a window in a text of any length.

    Longer texts are scanned in overlapping pieces; the overlap holds any region that a
    window can match.
    """
    result: dict[int, int] = {}
    overlap = 4 * max(map(len, index.windows), default=0)
    for at in range(0, max(len(text), 1), pieces):
        piece = text[at : at + pieces + overlap]
        for _, window, edits in matches(index, piece):
            item = int(index.owners[window])
            result[item] = min(edits, result.get(item, edits))
    for item in index.whole.get(text, []):
        result[item] = 0
    return result


def matches(
    index: Index, text: bytes, ends: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(text, window, edits) of verified bands: those that decide each item's fewest edits.

    ``ends`` are the ends of joined texts. Per text and item the band with the most shared
    q-grams is verified first; where it is an exact copy, which nothing can better, the
    item's other bands (many, in a text that repeats itself) need no alignment.
    """
    window, first, seen = index.candidates(text)
    if not len(window):
        return []
    number = np.zeros(len(window), np.int64)
    if ends is not None:
        lengths = np.array([len(w) for w in index.windows], np.int64)[window]
        middle = first + index.edits[window] + lengths // 2
        number = np.searchsorted(ends, middle, side="right")
    _, owner = np.unique(index.owners[window], return_inverse=True)
    group = number * (int(owner.max()) + 1) + owner
    order = np.lexsort((-seen, group))
    best = order[np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])]
    edits = np.full(len(window), 1 << 20, np.int64)
    edits[best] = index.distances(text, window[best], first[best])
    rest = ~np.isin(group, group[best[edits[best] == 0]])
    rest[best] = False
    rest = np.flatnonzero(rest)
    if len(rest):
        edits[rest] = index.distances(text, window[rest], first[rest])
    good = edits <= index.edits[window]
    return list(zip(number[good].tolist(), window[good].tolist(), edits[good].tolist()))


def scan(index: Index, batch: list[bytes]) -> list[dict[int, int]]:
    """``found_in`` for many texts: short ones are screened together."""
    normals = [normal(t) for t in batch]
    results: list[dict[int, int] | None] = [None] * len(batch)
    group, held = [], 0
    for i, text in enumerate(normals):
        if len(text) > SCAN_BYTES:
            results[i] = found_in(index, text)
            continue
        group.append(i)
        held += len(text)
        if held > SCAN_BYTES:
            screen(index, normals, group, results)
            group, held = [], 0
    if group:
        screen(index, normals, group, results)
    return [r or {} for r in results]


def screen(index, normals, group, results) -> None:
    """``found_in`` for short texts joined into one.

    They are parted by more NUL bytes, which no window holds, than any window's edit
    budget: no region within the budget reaches into two texts.
    """
    gap = b"\0" * (int(index.edits.max(initial=0)) + Q)
    joined = gap.join(normals[i] for i in group)
    ends = np.cumsum([len(normals[i]) + len(gap) for i in group])
    for number, window, edits in matches(index, joined, ends):
        i = group[number]
        found = results[i] = results[i] or {}
        item = int(index.owners[window])
        found[item] = min(edits, found.get(item, edits))
    for i in group:
        if normals[i] in index.whole:
            results[i] = (results[i] or {}) | dict.fromkeys(index.whole[normals[i]], 0)


def slices(benchmark: DataFrame, item_id: str, text: str, limit: int):
    """The benchmark's items in lists of about ``limit`` bytes at most."""
    items = benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text")
    ).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // limit) + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r.item_id, r.text.encode()) for r in part.collect()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_rate: float = EDIT_RATE,
    window: int = WINDOW_BYTES,
    slice_bytes: int = SLICE_BYTES,
    keep: list[str] | None = None,
    text: str = "text",
    inside: str | None = None,
) -> DataFrame:
    """The kept columns (default ``doc_id``) of every row, ``item_ids`` and ``min_edits``.

    The text is a column, or a field of the kept struct column ``inside``.

    ``item_ids`` lists, sorted, the benchmark items of which a window lies in the text
    within ``edit_rate`` edits a byte; ``min_edits`` is the fewest (null if none). Null
    and blank texts match nothing; items with null id or text are ignored; an item of
    fewer than eight bytes matches only a text that equals it; an empty benchmark matches
    nothing. Rows are judged each for itself, so repeated rows stay repeated; other
    columns are ignored.
    """
    spark = session(docs)
    keep = keep or ["doc_id"]
    found = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        *([] if inside else [F.col(text).cast("string").alias("_text")]),
        F.expr("cast(array() as array<bigint>)").alias("item_ids"),
        F.lit(None).cast("bigint").alias("min_edits"),
    )
    held = []
    for items in slices(benchmark, "item_id", "text", slice_bytes):
        if len(held) == SLICES_A_STAGE:
            found = materialize(found, "decontam")
            while held:
                held.pop().unpersist()
        shared = spark.sparkContext.broadcast(items)
        held.append(shared)
        schema = found.schema

        path = (inside, text) if inside else ("_text",)

        def run(batches, shared=shared):
            index = Index(shared.value, window, edit_rate)
            for batch in batches_of(batches):
                results = scan(index, texts(batch, *path))
                old = batch.column("item_ids").to_pylist()
                ids = [sorted({*o, *r}) for o, r in zip(old, results)]
                fewest = [
                    min([*([e] if e is not None else []), *r.values()], default=None)
                    for e, r in zip(batch.column("min_edits").to_pylist(), results)
                ]
                columns = batch.columns[:-2]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.list_(pa.int64())), pa.array(fewest, pa.int64())],
                    names=batch.schema.names,
                )

        found = over_batches(found, run, schema)
    return found.drop("_text")


def keep_uncontaminated(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE
) -> DataFrame:
    """The rows of which no benchmark item was found, with all their columns as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    judged = contamination(rows, benchmark, edit_rate, keep=["_row"], inside="_row")
    return judged.where(F.size("item_ids") == 0).select("_row.*")
