"""Batches of text as NumPy arrays: words, their hashes and shingles, without a loop over characters.

White space is `[\\x20\\x09-\\x0D]`, all of it ASCII, so that it never cuts a UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
MOST_ROWS = 1 << 12
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SOLID = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    SOLID[_low:_high] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROOT = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values, one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(_ROOT, -1, 1 << 64)
    made = []
    for base in (_ROOT, inverse):
        steps = np.full(size, base, np.uint64)
        steps[:1] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(16, (size - 1).bit_length()))


class Texts:
    """Some texts, one after another, as one array of bytes. Null counts as empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        """A-Z lower-cased."""
        return Texts(LOWER[self.data], self.offsets)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the text that holds it."""
        solid = ~SPACES[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.empty_like(solid)
        before[:1], before[1:] = False, solid[:-1]
        starts = np.flatnonzero(solid & (edge[:-1] | ~before))
        after = np.empty_like(solid)
        after[-1:], after[:-1] = False, solid[1:]
        ends = np.flatnonzero(solid & (edge[1:] | ~after)) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span of bytes."""
        forward, back = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_byte_values()[self.data] * forward[: len(self.data)], out=total[1:])
        return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _ODD)


def texts_of(column: pa.Array) -> Texts:
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in runs of rows of about so many bytes of text, so that arrays stay small; a long text is whole."""
    texts = texts_of(batch.column(column))
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(texts.offsets, texts.offsets[start] + most, "right")) - 1
        end = min(max(end, start + 1), start + MOST_ROWS, len(texts))
        low, high = texts.offsets[start], texts.offsets[end]
        yield batch.slice(start, end - start), Texts(texts.data[low:high], texts.offsets[start : end + 1] - low)
        start = end


def normalised(texts: Texts) -> tuple[Texts, np.ndarray]:
    """Each text as its runs of letters, digits and bytes beyond ASCII, A-Z lower-cased, with one space in between.

    The second result is where each byte was before.
    """
    data = np.where(SOLID[texts.data], LOWER[texts.data], np.uint8(32))
    first = np.zeros(len(data) + 1, bool)
    first[texts.offsets] = True
    keep = data != 32
    keep[1:] |= (data[1:] == 32) & (data[:-1] != 32) & ~first[1:-1]
    places = np.flatnonzero(keep)
    offsets = np.searchsorted(places, texts.offsets)
    last = np.unique(offsets[1:][offsets[1:] > offsets[:-1]]) - 1
    places = np.delete(places, last[data[places[last]] == 32])
    return Texts(data[places], np.searchsorted(places, texts.offsets)), places


def sequence_hashes(words: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of so many words of one text, and the text."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, owner.dtype)
    total = np.full(count, length, np.uint64)
    for i in range(length):
        total *= _ODD
        total += words[i : i + count]
    inside = owner[:count] == owner[length - 1 :]
    return mix(total[inside]), owner[:count][inside]


def shingle_sets(texts: Texts, length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as ascending 48-bit hashes, one text after another, and where each begins.

    A text of fewer words has one shingle of them all, a text without words none. At most 65,536 texts at once.
    """
    starts, ends, owner = texts.words()
    words = texts.hashes(starts, ends)
    parts = [sequence_hashes(words, owner, length)]
    counts = np.bincount(owner, minlength=len(texts))
    for fewer in range(1, length):
        few = counts[owner] == fewer
        parts.append(sequence_hashes(words[few], owner[few], fewer))
    keyed = np.concatenate([(o.astype(np.uint64) << np.uint64(48)) | (v >> np.uint64(16)) for v, o in parts])
    keyed.sort()
    keyed = keyed[np.append(True, keyed[1:] != keyed[:-1])] if len(keyed) else keyed
    begins = np.searchsorted(keyed, np.arange(len(texts), dtype=np.uint64) << np.uint64(48))
    return keyed & np.uint64((1 << 48) - 1), np.append(begins, len(keyed))
