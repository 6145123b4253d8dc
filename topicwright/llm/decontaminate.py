"""Benchmark decontamination: shared q-grams in overlapping diagonal bands, verified by banded alignment.

Texts are compared as runs of letters, digits and other bytes, with A-Z lower-cased and one space for all else in between.
Each benchmark item is cut into overlapping windows of WINDOW bytes (a shorter item is one window), and an item of more than RUN
characters also into short windows of so many, one every STRIDE characters. A window is found in a
text when a stretch of the text turns into it by at most `budget` edits: EDITS_PER_100 for each 100 bytes of the window, RUN_EDITS
for a short one, and less than one for each Q bytes. Each run of RUN + STRIDE - 1 characters of an item holds a whole short window, so
a text that holds such a run is found wherever in the item it begins, with up to RUN_EDITS edits in it.
By the q-gram lemma such a stretch shares at least `m + 1 - Q * (budget + 1)` q-grams with a window of m bytes, on diagonals that differ by no
more than the budget. Bands of diagonals, twice as wide as that and overlapping by half, thus each hold all
of them for some band. Bands with fewer shared q-grams are left out; the others are aligned, only near their diagonals.

A text leaks an item when it holds a window of it. The benchmark is cut into blocks of BLOCK_BYTES, each of which goes to every
executor in a pass of its own, so that nothing of unknown size is broadcast.

Null and empty texts hold nothing. Items of fewer than LEAST bytes can't be told from everyday phrases within a sentence: they are found
where a whole line or a whole text equals them; those without a letter or digit are never found. Each row of the benchmark is an
item of its own, reported with its id, also where that is null or repeated. Repeated rows of documents are each reported.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwright.llm.text_arrays import Texts, mix, normalised, slices

Q = 10
WINDOW = 100
EDITS_PER_100 = 8
RUN = 50
STRIDE = 10
RUN_EDITS = 2
LEAST = 30
#: An item's q-grams are held once for each window around them, about six times.
BLOCK_BYTES = 2 << 20

def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes from each place on."""
    count = len(data) - Q + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    eight = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        eight |= data[i : len(data) - 7 + i].astype(np.uint64) << np.uint64(8 * i)
    return mix(eight[:count] * np.uint64(0x9E3779B97F4A7C15) + eight[Q - 8 : Q - 8 + count])


@dataclass
class Windows:
    """Windows of benchmark items and the places of their q-grams."""

    items: np.ndarray
    texts: list[np.ndarray]
    budgets: np.ndarray
    keys: np.ndarray
    begins: np.ndarray
    window: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    lengths: np.ndarray
    short: dict[bytes, list[int]]
    short_keys: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> Windows:
        column, _ = normalised(texts_from(texts))
        items, parts, edits, short = [], [], [], {}
        for i, item in enumerate(ids):
            data = np.frombuffer(column.bytes_of(i), np.uint8)
            if len(data) < LEAST:
                if len(data):
                    short.setdefault(data.tobytes(), []).append(item)
                continue
            last = max(0, len(data) - WINDOW)
            for start in sorted({*range(0, last, WINDOW // 2), last}):
                items.append(item)
                parts.append(data[start : start + WINDOW])
                edits.append(len(parts[-1]) * EDITS_PER_100 // 100)
            # Places of characters: bytes other than those that continue one, and the end.
            chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            last = len(chars) - 1 - RUN
            if last > 0:
                for start in sorted({*range(0, last, STRIDE), last}):
                    items.append(item)
                    parts.append(data[chars[start] : chars[start + RUN]])
                    edits.append(RUN_EDITS)
        hashes = [grams(x) for x in parts]
        every = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        window = np.repeat(np.arange(len(parts)), [len(x) for x in hashes])
        place = np.concatenate([*(np.arange(len(x)) for x in hashes), np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        keys, begins = np.unique(every[order], return_index=True)
        sieve = np.zeros(1 << 22, bool)
        sieve[(keys >> np.uint64(42)).astype(np.int64)] = True
        # Never so many that no q-gram needs to be shared.
        budgets = np.array([min(e, len(x) // Q - 1) for e, x in zip(edits, parts)], np.int64)
        lengths = np.array([len(x) for x in parts], np.int64)
        said = texts_from([x.decode("utf-8", "replace") for x in short])
        short_keys = said.hashes(said.offsets[:-1], said.offsets[1:])
        return cls(np.array(items, np.int64), parts, budgets, keys, np.append(begins, len(order)), window[order], place[order], sieve, lengths, short, short_keys)

    @property
    def reach(self) -> int:
        return int(self.lengths.max(initial=0))

    def bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal of each band that shares enough q-grams with the window."""
        hashes = grams(data)
        seen = np.flatnonzero(self.sieve[(hashes >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[seen]), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == hashes[seen] if len(self.keys) else np.zeros(0, bool)
        seen, at = seen[hit], at[hit]
        times = self.begins[at + 1] - self.begins[at]
        of = np.repeat(np.arange(len(seen)), times)
        entry = self.begins[at][of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        window = self.window[entry]
        diagonal = seen[of] - self.place[entry] + self.reach
        step = self.budgets[window] + 1
        band = diagonal // step
        size = np.int64(len(data) + 2 * self.reach + 2)
        keys = np.concatenate([window * size + band, window * size + band - 1])
        keys, shared = np.unique(keys, return_counts=True)
        window, band = keys // size, keys % size
        enough = shared >= self.lengths[window] + 1 - Q * (self.budgets[window] + 1)
        window, band = window[enough], band[enough]
        return window, band * (self.budgets[window] + 1) - self.reach


def texts_from(texts: list[str]) -> Texts:
    raw = [(x or "").encode() for x in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return Texts(data, np.append(0, np.cumsum([len(x) for x in raw], dtype=np.int64)))


def align(patterns: np.ndarray, stretches: np.ndarray, diagonals: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn a part of each stretch into its pattern, and where that part ends.

    Only diagonals from 0 to `diagonals` are looked at: byte i of a pattern meets bytes i to i + diagonals of its stretch.
    """
    number, length = patterns.shape
    wide = diagonals + 1
    steps = np.arange(wide, dtype=np.int32)
    cost = np.zeros((number, wide), np.int32)
    for i in range(length):
        other = (stretches[:, i : i + wide] != patterns[:, i : i + 1]).astype(np.int32)
        best = cost + other
        best[:, :-1] = np.minimum(best[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(best - steps, axis=1) + steps
    end = cost.argmin(1)
    return cost[np.arange(number), end], end + length


def found_in(texts: Texts, windows: Windows) -> tuple[np.ndarray, ...]:
    """Text, item, edits, first and last byte (exclusive) of each window found, one row each."""
    plain, places = normalised(texts)
    window, first = windows.bands(plain.data)
    rows = []
    for length, budget in sorted({(int(windows.lengths[w]), int(windows.budgets[w])) for w in np.unique(window)}):
        mine = np.flatnonzero((windows.lengths[window] == length) & (windows.budgets[window] == budget))
        for low in range(0, len(mine), 4096):
            part = mine[low : low + 4096]
            diagonals = 2 * (budget + 1)
            start = first[part] - budget
            owner = np.searchsorted(plain.offsets, np.clip(first[part] + budget + 1 + length // 2, 0, max(len(plain.data) - 1, 0)), "right") - 1
            owner = np.clip(owner, 0, len(texts) - 1)
            at = start[:, None] + np.arange(length + diagonals + 2 * budget + 1)
            inside = (at >= plain.offsets[owner][:, None]) & (at < plain.offsets[owner + 1][:, None])
            stretch = np.where(inside, plain.data[np.clip(at, 0, len(plain.data) - 1)], 0)
            pattern = np.array([windows.texts[w] for w in window[part]]).reshape(-1, length)
            edits, end = align(pattern, stretch, diagonals + 2 * budget)
            good = np.flatnonzero(edits <= budget)
            if not len(good):
                continue
            # The same from the end backwards gives the beginning.
            back = end[good, None] - 1 - np.arange(length + budget + 1)
            reverse = np.where(back >= 0, stretch[good[:, None], np.maximum(back, 0)], 0)
            _, size = _prefix(pattern[good][:, ::-1], reverse, budget)
            last = start[good] + end[good]
            rows.append((owner[good], windows.items[window[part]][good], edits[good], last - size, last))
    whole = whole_lines(texts, windows)
    if not rows:
        return whole
    owner, item, edits, begin, last = (np.concatenate(x) for x in zip(*rows))
    # Back from the compared bytes to those of the whole text.
    begin, last = places[np.maximum(begin, 0)], places[np.maximum(last - 1, 0)] + 1
    found = (owner, item, edits, begin - texts.offsets[owner], last - texts.offsets[owner])
    return tuple(np.concatenate(x) for x in zip(found, whole))


def whole_lines(texts: Texts, windows: Windows) -> tuple[np.ndarray, ...]:
    """The same of each short item that a line, or a text of several lines, equals."""
    rows = []
    if windows.short:
        breaks = np.flatnonzero(texts.data == 10) + 1
        starts = np.append(np.sort(np.concatenate([texts.offsets[:-1], breaks]), kind="stable"), len(texts.data))
        several = np.bincount(np.searchsorted(texts.offsets[1:], breaks - 1, "right"), minlength=len(texts)) > 0
        lines = np.repeat(np.arange(len(texts)), 1 + np.bincount(np.searchsorted(texts.offsets[1:], breaks - 1, "right"), minlength=len(texts)))
        for parts, of, taken in ((starts, lines, np.ones(len(lines), bool)), (texts.offsets, np.arange(len(texts)), several)):
            plain, places = normalised(Texts(texts.data, parts))
            low, high = plain.offsets[:-1], plain.offsets[1:]
            for i in np.flatnonzero(taken & (high > low) & np.isin(plain.hashes(low, high), windows.short_keys)):
                for item in windows.short.get(plain.bytes_of(i), ()):
                    begin, last = places[low[i]], places[high[i] - 1] + 1
                    rows.append((of[i], item, 0, begin - texts.offsets[of[i]], last - texts.offsets[of[i]]))
    return tuple(np.array(rows, np.int64).reshape(-1, 5).T)


def _prefix(patterns: np.ndarray, stretches: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits from each pattern to a beginning of its stretch, and how long that is."""
    number, length = patterns.shape
    wide = stretches.shape[1] + 1
    steps = np.arange(wide, dtype=np.int32)
    cost = np.tile(steps, (number, 1))
    for i in range(length):
        best = cost + 1
        other = (stretches != patterns[:, i : i + 1]).astype(np.int32)
        best[:, 1:] = np.minimum(best[:, 1:], cost[:, :-1] + other)
        cost = np.minimum.accumulate(best - steps, axis=1) + steps
    end = cost.argmin(1)
    return cost[np.arange(number), end], end


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, edits, first_byte, last_byte): each item that a text holds windows of.

    Of documents (doc_id bigint, text string) and benchmark (item_id bigint, text string). `windows` windows were found, the closest
    with `edits` edits; all lie from `first_byte` up to `last_byte` of the text in UTF-8.
    """
    kind = "doc_id bigint, item_id bigint, windows bigint, edits bigint, first_byte bigint, last_byte bigint"
    spark = documents.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    result = spark.createDataFrame([], kind)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        windows = spark.sparkContext.broadcast((Windows.of(list(range(len(mine))), [r.text for r in mine]), [r.item_id for r in mine]))

        def run(batches, windows=windows):
            held, names = windows.value
            for batch in batches:
                for rows, texts in slices(batch, "text"):
                    owner, item, edits, begin, end = found_in(texts, held)
                    ids, parts = rows.column("doc_id").to_pylist(), {}
                    for o, i, e, b, n in zip(*(x.tolist() for x in (owner, item, edits, begin, end))):
                        w, e0, b0, n0 = parts.get((o, i), (0, e, b, n))
                        parts[o, i] = (w + 1, min(e, e0), min(b, b0), max(n, n0))
                    found = [(ids[o], names[i], *x) for (o, i), x in parts.items()]
                    yield pa.record_batch(
                        [pa.array([x[k] for x in found], pa.int64()) for k in range(6)],
                        ["doc_id", "item_id", "windows", "edits", "first_byte", "last_byte"],
                    )

        result = result.union(documents.select("doc_id", "text").mapInArrow(run, kind))
    return result


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that hold no window of any benchmark item, with all their columns."""
    spark = documents.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        windows = spark.sparkContext.broadcast(Windows.of(list(range(len(mine))), [r.text for r in mine]))

        def run(batches, windows=windows):
            for batch in batches:
                for rows, texts in slices(batch, "text"):
                    clean = np.ones(len(texts), bool)
                    clean[found_in(texts, windows.value)[0]] = False
                    yield rows.filter(pa.array(clean))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
