"""Islands of offsets: runs of consecutive offsets, and sets of such runs.

An interval set maps a partition to ascending half-open runs ``(start, end)`` that don't touch. It is held by the driver and in
state files, as packed bits; it is empty where a partition is read without gaps.
"""

from __future__ import annotations

import zlib
from base64 import b64decode, b64encode
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicwright.operators import ranges
from topicwright.operators.offsets import local_table

Intervals = dict[int, list[tuple[int, int]]]

_PARTITION = ["topic", "partition"]

# 2^20 offsets: a piece of packed bits, 128 KB before it is compressed; and 2^15, what Spark's bitmaps hold.
PIECE_BITS = 20
_BITMAP_BITS = 15
_PIECE = 1 << PIECE_BITS


def offset_islands(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Each run of consecutive offsets of the rows, ``(*by, start_offset, end_offset)``; repeated offsets count once.

    Offsets are put in order within segments, so no task holds more of a partition than that. Only runs that reach
    the border of a segment, two for each at most, are then joined over the whole partition.
    """
    by = by or _PARTITION
    placed = rows.select(*by, "offset", ranges.segment_of(F.col("offset")).alias("_segment"))
    rank = F.dense_rank().over(Window.partitionBy(*by, "_segment").orderBy("offset"))
    runs = placed.select("*", (F.col("offset") - rank).alias("_run")).groupBy(*by, "_segment", "_run")
    runs = runs.agg(F.min("offset").alias("start_offset"), (F.max("offset") + 1).alias("end_offset"))
    inner = (1 << ranges.SEGMENT_BITS) - 1
    at_border = (F.col("start_offset").bitwiseAND(inner) == 0) | (F.col("end_offset").bitwiseAND(inner) == 0)
    in_order = Window.partitionBy(*by).orderBy("start_offset")
    new = (F.lag("end_offset").over(in_order) == F.col("start_offset")).cast("int")
    chained = runs.filter(at_border).select(*by, "start_offset", "end_offset", F.coalesce(1 - new, F.lit(1)).alias("_new"))
    chained = chained.select("*", F.sum("_new").over(in_order).alias("_island")).groupBy(*by, "_island")
    joined = chained.agg(F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))
    columns = [*by, "start_offset", "end_offset"]
    return runs.filter(~at_border).select(*columns).unionByName(joined.select(*columns))


def _packed(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")


class PackedIntervals(Mapping):
    """An interval set as compressed bits of pieces of a partition; runs are made from them when a partition is asked for.

    Runs of one offset each take a bit of two, not two numbers, and a change only packs the pieces anew that it touches. So a
    batch costs what it holds, however much lies behind gaps already. It is never changed in place.
    """

    def __init__(self, pieces: Mapping[int, Mapping[int, bytes]] | None = None):
        self._pieces = {p: dict(own) for p, own in (pieces or {}).items() if own}

    @classmethod
    def of(cls, intervals: Mapping[int, Iterable[tuple[int, int]]]) -> PackedIntervals:
        if isinstance(intervals, PackedIntervals):
            return intervals
        pieces: dict[int, dict[int, np.ndarray]] = {}
        for partition, spans in intervals.items():
            for start, end in spans:
                for piece in range(start >> PIECE_BITS, ((end - 1) >> PIECE_BITS) + 1 if end > start else 0):
                    base = piece << PIECE_BITS
                    bits = pieces.setdefault(partition, {}).setdefault(piece, np.zeros(_PIECE, np.uint8))
                    bits[max(0, start - base) : end - base] = 1
        return cls({p: {piece: _packed(bits) for piece, bits in own.items()} for p, own in pieces.items()})

    @classmethod
    def parsed(cls, content: Mapping[str, Mapping[str, str] | list]) -> PackedIntervals:
        """From a state file; one with lists of runs is read as well."""
        spans = {int(p): [(int(a), int(b)) for a, b in own] for p, own in content.items() if isinstance(own, list)}
        pieces = {
            int(p): {int(piece): b64decode(text, validate=True) for piece, text in own.items()}
            for p, own in content.items() if not isinstance(own, list)
        }
        for own in pieces.values():
            if any(len(zlib.decompress(packed)) != _PIECE // 8 for packed in own.values()):
                raise ValueError("a piece of another size")
        return cls.of(spans).united(cls(pieces))

    def content(self) -> dict[str, dict[str, str]]:
        """For a state file."""
        return {
            str(p): {str(piece): b64encode(own[piece]).decode() for piece in sorted(own)} for p, own in sorted(self._pieces.items())
        }

    def united(self, other: PackedIntervals) -> PackedIntervals:
        pieces = dict(self._pieces)
        for partition, more in other._pieces.items():
            own = dict(pieces.get(partition, {}))
            for piece, packed in more.items():
                own[piece] = _packed(_unpacked(own[piece]) | _unpacked(packed)) if piece in own else packed
            pieces[partition] = own
        return PackedIntervals(pieces)

    def advanced(
        self, positions: Mapping[int, int], partitions: Iterable[int] | None = None
    ) -> tuple[dict[int, int], PackedIntervals]:
        """Positions moved on over the runs that they touch, of some partitions or all, and the runs that are still behind a gap."""
        moved, pieces = dict(positions), dict(self._pieces)
        for partition in list(self._pieces) if partitions is None else partitions:
            own, at = dict(pieces.get(partition, {})), moved.get(partition, 0)
            for piece in sorted(own):
                base = piece << PIECE_BITS
                if base > at:
                    break
                packed = own.pop(piece)
                if at >= base + _PIECE:
                    continue
                bits = _unpacked(packed)
                gaps = np.flatnonzero(bits[at - base :] == 0)
                at = at + int(gaps[0]) if len(gaps) else base + _PIECE
                bits[: at - base] = 0
                if bits.any():
                    own[piece] = _packed(bits)
            if partition in pieces and (at or partition in moved):
                moved[partition] = at
            pieces[partition] = own
        return moved, PackedIntervals(pieces)

    def __getitem__(self, partition: int) -> list[tuple[int, int]]:
        starts, ends = [], []
        for piece, packed in sorted(self._pieces[partition].items()):
            edges = np.flatnonzero(np.diff(_unpacked(packed), prepend=0, append=0)) + (piece << PIECE_BITS)
            starts.append(edges[::2])
            ends.append(edges[1::2])
        starts, ends = np.concatenate(starts), np.concatenate(ends)
        # Runs that go on in the next piece.
        apart = starts[1:] != ends[:-1]
        return list(zip(starts[np.append(True, apart)].tolist(), ends[np.append(apart, True)].tolist()))

    def __iter__(self) -> Iterator[int]:
        return iter(sorted(self._pieces))

    def __len__(self) -> int:
        return len(self._pieces)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Mapping) and dict(self) == dict(other)

    __hash__ = None

    def __repr__(self) -> str:
        return f"PackedIntervals({ {p: len(own) for p, own in sorted(self._pieces.items())} } pieces)"


def collect_packed(rows: DataFrame) -> PackedIntervals:
    """The islands of one topic's rows on the driver, as bits that the tasks put together: no offset is sorted or sent by itself."""
    inner = (1 << _BITMAP_BITS) - 1
    placed = rows.select(
        "partition", F.shiftright("offset", _BITMAP_BITS).alias("bitmap"), F.col("offset").bitwiseAND(inner).alias("place")
    )
    pieces: dict[int, dict[int, np.ndarray]] = {}
    for partition, bitmap, bits in placed.groupBy("partition", "bitmap").agg(F.bitmap_construct_agg("place")).collect():
        at = (bitmap << _BITMAP_BITS) & (_PIECE - 1)
        piece = pieces.setdefault(partition, {}).setdefault(bitmap >> (PIECE_BITS - _BITMAP_BITS), np.zeros(_PIECE, np.uint8))
        piece[at : at + inner + 1] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    return PackedIntervals({p: {piece: _packed(bits) for piece, bits in own.items()} for p, own in pieces.items()})


def collect_islands(rows: DataFrame) -> Intervals:
    """The islands of one topic's rows on the driver."""
    found: Intervals = {}
    for partition, start, end in offset_islands(rows, ["partition"]).collect():
        found.setdefault(partition, []).append((start, end))
    return united(found)


def united(*sets: Mapping[int, Iterable[tuple[int, int]]]) -> Intervals:
    """All runs of several sets, joined where they touch or overlap."""
    out: Intervals = {}
    for partition in sorted({p for s in sets for p in s}):
        merged: list[tuple[int, int]] = []
        for start, end in sorted(span for s in sets for span in s.get(partition, ())):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        if merged:
            out[partition] = merged
    return out


def advanced(positions: Mapping[int, int], ahead: Intervals) -> tuple[dict[int, int], Intervals]:
    """Positions moved on over the runs that they touch, and the runs that are still behind a gap."""
    moved, left = dict(positions), {}
    for partition, spans in ahead.items():
        at = moved.get(partition, 0)
        for start, end in spans:
            if start <= at:
                at = max(at, end)
        if at or partition in moved:
            moved[partition] = at
        behind = [(start, end) for start, end in spans if start > at]
        if behind:
            left[partition] = behind
    return moved, left


def last_at_most(values: Column, wanted: Column, most: int) -> Column:
    """The place of the last of ascending values (at most so many) that isn't above the wanted one, -1 if all are."""
    steps = F.array(*[F.lit(1 << k) for k in range(max(1, most).bit_length() - 1, -1, -1)])

    def step(at: Column, width: Column) -> Column:
        there = F.get(values, at + width)
        return F.when((at + width < F.size(values)) & (there <= wanted), at + width).otherwise(at)

    return F.reduce(steps, F.lit(-1), step)


def outside(rows: DataFrame, held: Intervals) -> DataFrame:
    """Rows of one topic whose offsets are in none of the runs."""
    if not held:
        return rows
    schema = pa.schema([("partition", pa.int32()), ("_starts", pa.list_(pa.int64())), ("_ends", pa.list_(pa.int64()))])
    lists = [(p, [a for a, _ in spans], [b for _, b in spans]) for p, spans in sorted(held.items())]
    # Its size is that of the state that the driver holds.
    table = F.broadcast(local_table(rows.sparkSession, lists, schema))
    place = last_at_most(F.col("_starts"), F.col("offset"), max(len(spans) for spans in held.values()))
    joined = rows.join(table, "partition", "left").withColumn("_place", place)
    inside = (F.col("_place") >= 0) & (F.col("offset") < F.get("_ends", F.col("_place")))
    return joined.filter(~F.coalesce(inside, F.lit(False))).select(*rows.columns)
