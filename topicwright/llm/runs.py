"""Periodic runs of words, found by string synchronising sets, and texts with the repeats taken out.

A run is a longest stretch of words in which words `period` apart are equal, for the smallest such period, with
EXPONENT periods and SHORTEST words at least. Words are hashed; all that follows is done on the words of a slice of
texts at once, one scale after another.

Periods below SMALL are found by comparing each word with the one so many words on. For longer periods there is a scale for each
power of two `t`. Its synchronising set holds the places whose next t + 1 windows of t words have their least hash at the
first or the last window. Whether a place is in the set depends only on the next 2 t words, and of any t
places in a row one is in it. Windows that lie in a region with a period of t / EXPONENT at most are left out, so that
such a region does not fill the set; these small periods are known from the scales before. Take a run of period p with
t <= p < 2 t: one of its first t places is in the set, its next 2 t words come again p words later and not before, and so that place
is in the set too. So neighbouring places with equal next 2 t words propose all periods from t to 2 t that there are.
Each proposal is extended both ways by comparing hashes of 2, 4, 8, ... words, and checked word by word.

Null texts and texts without words have no run and are empty afterwards. Each row is judged on its own: repeated rows and
rows with equal or null ids give a row each. Other columns than `doc_id` and `text` are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from topicwright.llm.text_arrays import Texts, mix, powers, slices

#: So many periods and so many words a run has at least.
EXPONENT = 4
SHORTEST = 6
#: Periods below this one are found by comparing words directly.
SMALL = 4

_LEFT_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)
_NONE = np.zeros((0, 3), np.int64)
SPANS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class _Words:
    """The words of some texts as hashes, with hashes of any stretch of them, and the text that each word is in."""

    def __init__(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        size = len(hashes)
        self.hashes, self.begins, self.ends = hashes, begins, ends
        forward, self.back = powers(size + 1)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(hashes * forward[:size], out=self.sums[1:])

    def stretch(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def equal_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on, b being the later place of the same text."""
        room = self.ends[b] - b
        length = np.zeros(len(a), np.int64)
        for step in _halving(room):
            open_ = np.flatnonzero(length + step <= room)
            x, y = a[open_] + length[open_], b[open_] + length[open_]
            length[open_] += step * (self.stretch(x, step) == self.stretch(y, step))
        return length

    def equal_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b."""
        room = a - self.begins[a]
        length = np.zeros(len(a), np.int64)
        for step in _halving(room):
            open_ = np.flatnonzero(length + step <= room)
            x, y = a[open_] - length[open_] - step, b[open_] - length[open_] - step
            length[open_] += step * (self.stretch(x, step) == self.stretch(y, step))
        return length


def _halving(room: np.ndarray) -> list[int]:
    most = int(room.max(initial=0))
    return [1 << k for k in range(most.bit_length() - 1, -1, -1)]


def _regions_of(words: _Words, period: int) -> np.ndarray:
    """All regions (start, end, period) of EXPONENT such periods at least, by comparing word by word."""
    if len(words.hashes) <= period:
        return _NONE
    same = np.zeros(len(words.hashes) - period + 2, np.int8)
    same[1:-1] = (words.hashes[:-period] == words.hashes[period:]) & (words.ends[:-period] == words.ends[period:])
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2] + period
    long = ends - starts >= EXPONENT * period
    return np.stack([starts[long], ends[long], np.full(long.sum(), period)], axis=1)


def _windows(words: _Words, scale: int, regions: np.ndarray) -> np.ndarray:
    """The hash of each window of so many words, and the greatest number for those that a small period fills."""
    count = len(words.hashes) - scale + 1
    hashes = mix((words.sums[scale:] - words.sums[:count]) * words.back[:count])
    filled = regions[(regions[:, 2] * EXPONENT <= scale) & (regions[:, 1] - regions[:, 0] >= scale)]
    if len(filled):
        depth = np.zeros(count + 1, np.int64)
        np.add.at(depth, filled[:, 0], 1)
        np.add.at(depth, filled[:, 1] - scale + 1, -1)
        hashes[np.cumsum(depth[:-1]) > 0] = _LEFT_OUT
    return hashes


def synchronising_set(words: _Words, scale: int, regions: np.ndarray) -> np.ndarray:
    """The places whose next scale + 1 windows have their least hash at the first or the last one."""
    hashes = _windows(words, scale, regions)
    count = len(hashes) - scale
    if count <= 0:
        return np.zeros(0, np.int64)
    least, wide = hashes, 1
    while wide < scale:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    least = np.minimum(least[:-1], least[1:])
    inside = words.ends[:count] - np.arange(count) >= 2 * scale
    edge = (least == hashes[:count]) | (least == hashes[scale:])
    return np.flatnonzero(inside & edge & (least != _LEFT_OUT))


def _proposals(words: _Words, places: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with equal next words that follow each other at a distance of one to two scales, and that distance."""
    context = mix(words.stretch(places, 2 * scale) ^ mix(words.ends[places].astype(np.uint64)))
    order = np.argsort(context, kind="stable")
    places, context = places[order], context[order]
    apart = places[1:] - places[:-1]
    taken = (context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale)
    return places[:-1][taken], apart[taken]


def _extended(words: _Words, places: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """The regions around proposals, each once; where hashes were mistaken, word by word."""
    if not len(places):
        return _NONE
    starts = places - words.equal_before(places, places + periods)
    ends = places + periods + words.equal_after(places, places + periods)
    found = np.stack([starts, ends, periods], axis=1)
    found = np.unique(found[ends - starts >= EXPONENT * periods], axis=0)
    exact, doubtful = [], set()
    for start, end, period in found.tolist():
        same = np.array_equal(words.hashes[start : end - period], words.hashes[start + period : end])
        left = start == words.begins[start] or words.hashes[start - 1] != words.hashes[start - 1 + period]
        right = end == words.ends[start] or words.hashes[end] != words.hashes[end - period]
        if same and left and right:
            exact.append((start, end, period))
        else:
            doubtful.add(period)
    again = [_regions_of(words, period) for period in sorted(doubtful)]
    return np.concatenate([np.array(exact, np.int64).reshape(-1, 3), *again])


def _smallest_periods(regions: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, by start."""
    regions = regions[np.lexsort((regions[:, 2], regions[:, 1], regions[:, 0]))]
    first = np.ones(len(regions), bool)
    first[1:] = (regions[1:, :2] != regions[:-1, :2]).any(axis=1)
    return regions[first]


def find_runs(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of texts with so many words each, in the order of their starts and periods.

    `hashes` are those of all words, one text after another; starts and ends count through all texts.
    """
    offsets = np.append(0, np.cumsum(counts))
    words = _Words(hashes, np.repeat(offsets[:-1], counts), np.repeat(offsets[1:], counts))
    regions = np.concatenate([_regions_of(words, period) for period in range(1, SMALL)])
    regions = _smallest_periods(regions)
    longest, scale = int(counts.max(initial=0)), SMALL
    while EXPONENT * scale <= longest:
        # Only texts that are long enough for such a run, as a string of their own.
        kept = counts >= EXPONENT * scale
        place = np.flatnonzero(np.repeat(kept, counts))
        base = np.append(0, np.cumsum(counts[kept]))
        part = _Words(hashes[place], np.repeat(base[:-1], counts[kept]), np.repeat(base[1:], counts[kept]))
        # Where each text began before, less where it begins now.
        shift = offsets[:-1][kept] - base[:-1]
        of = np.searchsorted(offsets, regions[:, 0], "right") - 1
        known, of = regions[kept[of]], of[kept[of]]
        moved = (np.cumsum(kept) - 1)[of]
        known = known - np.stack([shift[moved], shift[moved], np.zeros(len(moved), np.int64)], axis=1)
        found = _extended(part, *_proposals(part, synchronising_set(part, scale, known), scale))
        back = shift[np.searchsorted(base, found[:, 0], "right") - 1] if len(found) else np.zeros(0, np.int64)
        found = found + np.stack([back, back, np.zeros(len(back), np.int64)], axis=1)
        regions = _smallest_periods(np.concatenate([regions, found]))
        scale *= 2
    runs = regions[regions[:, 1] - regions[:, 0] >= np.maximum(SHORTEST, EXPONENT * regions[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(texts: Texts, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, kept: np.ndarray) -> Texts:
    """Each text as its kept words, joined by one space."""
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    first = np.ones(len(starts), bool)
    first[1:] = owner[1:] != owner[:-1]
    depth = np.zeros(len(texts.data) + 1, np.int8)
    depth[starts] += 1
    depth[ends] -= 1
    taken = np.cumsum(depth[:-1], dtype=np.int8) > 0
    # The white space before a word that is not the first kept one becomes the one space.
    gaps = starts[~first] - 1
    data = texts.data.copy()
    data[gaps], taken[gaps] = 32, True
    total = np.append(0, np.cumsum(taken))
    return Texts(data[taken], total[texts.offsets])


def _strings(texts: Texts) -> pa.Array:
    offsets = pa.py_buffer(texts.offsets.astype(np.int32))
    return pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(np.ascontiguousarray(texts.data)))


def periodic_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of documents (doc_id bigint, text string).

    Words are runs of other characters than white space, numbered from 0. `runs` are in the order of their starts and periods.
    `collapsed` is the text without the words that lie in a run behind its first period, joined by one space.
    """

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                starts, ends, owner = texts.words()
                counts = np.bincount(owner, minlength=len(texts))
                found = find_runs(texts.hashes(starts, ends), counts)
                depth = np.zeros(len(starts) + 1, np.int64)
                np.add.at(depth, found[:, 0] + found[:, 2], 1)
                np.add.at(depth, found[:, 1], -1)
                left = collapsed(texts, starts, ends, owner, np.cumsum(depth[:-1]) == 0)
                offsets = np.append(0, np.cumsum(counts))
                of = np.searchsorted(offsets, found[:, 0], "right") - 1
                columns = [found[:, 0] - offsets[of], found[:, 1] - found[:, 0], found[:, 2]]
                spans = pa.StructArray.from_arrays([pa.array(x) for x in columns], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32()), spans)
                yield pa.record_batch([rows.column("doc_id"), lists, _strings(left)], ["doc_id", "runs", "collapsed"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, runs {SPANS}, collapsed string")
