"""Planning and reading offset ranges."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.operators.offsets import OffsetError, local_table

# Fixed value: assumed bytes per message in size estimates.
MESSAGE_BYTES = 1024
# Up to this many ranges a literal predicate is used, which reaches the Parquet row groups. More are
# grouped by their segments, and at most this many groups become predicates on folders.
LITERAL_RANGES = 200
# Above this many ranges (32 bytes and a topic name each) the range table is no longer hinted for broadcast.
BROADCAST_RANGES = 1_000_000

# 2^20 messages: the offsets of one segment folder of a topic table.
SEGMENT_BITS = 20

_PARTITION = ["topic", "partition"]


class OffsetRange(NamedTuple):
    topic: str
    partition: int
    start_offset: int
    end_offset: int


def segment_of(offset: Column) -> Column:
    """Segment of a topic table that holds an offset."""
    return F.shiftright(offset, SEGMENT_BITS)


def segment_number(offset: int) -> int:
    return offset >> SEGMENT_BITS


def any_of(conditions: list[Column]) -> Column:
    """True where any holds, as a balanced tree, which stays shallow for thousands of them."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def in_segments(spans: Mapping[tuple[str, int], tuple[int, int | None]]) -> Column:
    """Folders of partitions ``(topic, partition)`` from a first to a last segment, or to the end for None.

    Partitions with the same span share a condition. Beyond LITERAL_RANGES different spans,
    neighbouring ones are joined to one that holds both, so more may pass, but never less.
    """
    groups: dict[tuple, list[int]] = {}
    for (topic, partition), (first, last) in spans.items():
        groups.setdefault((topic, first, float("inf") if last is None else last), []).append(partition)
    ordered = sorted(groups.items())
    share = -(-len(ordered) // LITERAL_RANGES)
    merged: list[tuple[str, int, float, list[int]]] = []
    for at, ((topic, first, last), partitions) in enumerate(ordered):
        if at % share and merged[-1][0] == topic:
            _, low, high, others = merged[-1]
            merged[-1] = (topic, min(low, first), max(high, last), others + partitions)
        else:
            merged.append((topic, first, last, partitions))
    conditions = []
    for topic, first, last, partitions in merged:
        later = F.col("segment") >= first
        inside = later if last == float("inf") else later & (F.col("segment") <= int(last))
        conditions.append((F.col("topic") == topic) & F.col("partition").isin(sorted(partitions)) & inside)
    return any_of(conditions)


def from_known_segments(known: Mapping[tuple[str, int], int]) -> Column:
    """Segments from that of each known offset on, and all of partitions without one."""
    topics: dict[str, list[int]] = {}
    for topic, partition in known:
        topics.setdefault(topic, []).append(partition)
    listed = [(F.col("topic") == t) & F.col("partition").isin(sorted(p)) for t, p in sorted(topics.items())]
    spans = {place: (segment_number(offset), None) for place, offset in known.items()}
    return in_segments(spans) | ~any_of(listed)


def plan_ranges(starts: DataFrame, bounds: DataFrame, max_records: int | None = None) -> DataFrame:
    """Half-open range ``[start_offset, end_offset)`` to read from each partition.

    ``max_records`` above zero caps the records per partition.
    """
    latest = F.col("latest")
    end = F.least(latest, F.col("offset") + max_records) if max_records and max_records > 0 else latest
    failure = F.raise_error(
        F.concat(
            F.lit("No valid end offset for topic "),
            "topic",
            F.lit(", partition "),
            F.col("partition").cast("string"),
        )
    ).cast("bigint")
    return starts.join(bounds, _PARTITION, "left").select(
        *_PARTITION,
        F.col("offset").alias("start_offset"),
        F.when(latest >= 0, end).otherwise(failure).alias("end_offset"),
    )


def collect_ranges(ranges: DataFrame) -> list[OffsetRange]:
    """The read plan on the driver: one row per topic partition."""
    columns = [*_PARTITION, "start_offset", "end_offset"]
    return sorted(OffsetRange(*row) for row in ranges.select(*columns).collect())


def range_table(spark: SparkSession, ranges: list[OffsetRange]) -> DataFrame:
    """Collected ranges as a relation again."""
    schema = pa.schema(
        [
            ("topic", pa.string()),
            ("partition", pa.int32()),
            ("start_offset", pa.int64()),
            ("end_offset", pa.int64()),
        ]
    )
    return local_table(spark, ranges, schema)


def read_ranges(log: DataFrame, ranges: list[OffsetRange]) -> DataFrame:
    """Rows of a topic log inside the ranges.

    Few ranges become a literal predicate, so partitions, segments and Parquet row groups
    outside them are never read. Many ranges become a join with the range table, behind a
    predicate on the folders of their segments.
    """
    wanted = [r for r in ranges if r.start_offset < r.end_offset]
    if not wanted:
        return log.filter(F.lit(False))
    segments = "segment" in log.columns
    if len(wanted) <= LITERAL_RANGES:
        inside = [
            (F.col("topic") == r.topic)
            & (F.col("partition") == r.partition)
            & _between(r.start_offset, r.end_offset, segments)
            for r in wanted
        ]
        return log.filter(any_of(inside))
    table = range_table(log.sparkSession, wanted)
    if len(wanted) <= BROADCAST_RANGES:
        table = F.broadcast(table)
    if segments:
        span = lambda r: (segment_number(r.start_offset), segment_number(r.end_offset - 1))
        log = log.filter(in_segments({(r.topic, r.partition): span(r) for r in wanted}))
    else:
        log = log.filter(F.col("topic").isin(sorted({r.topic for r in wanted})))
    joined = log.join(table, _PARTITION)
    inside = (F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
    return joined.filter(inside).select(*log.columns)


def _between(start: int, end: int, segments: bool) -> Column:
    offset = (F.col("offset") >= start) & (F.col("offset") < end)
    if not segments:
        return offset
    return F.col("segment").between(start >> SEGMENT_BITS, (end - 1) >> SEGMENT_BITS) & offset


def check_whole(ranges: list[OffsetRange], bounds: DataFrame, dense: bool = True) -> None:
    """Fail if a planned range cannot be read whole.

    Offsets of a topic table run without gaps (``dense``), so a partition with fewer messages than
    offsets has lost some, or an append to it is still in flight. A live topic that is compacted or
    written in transactions has gaps that are no loss.
    """
    found = {(row.topic, row.partition): row for row in bounds.collect()}
    problems = []
    for r in ranges:
        bound = found[(r.topic, r.partition)]
        if r.start_offset >= r.end_offset:
            continue
        if r.start_offset < bound.earliest:
            problems.append(
                f"Offsets {r.start_offset} to {bound.earliest} of topic {r.topic}, "
                f"partition {r.partition} are no longer there."
            )
        if dense and bound.messages != bound.latest - bound.earliest:
            problems.append(
                f"Topic {r.topic}, partition {r.partition} holds {bound.messages} messages "
                f"for offsets {bound.earliest} to {bound.latest}."
            )
    if problems:
        raise OffsetError("\n".join(problems))


def backlog(ranges: DataFrame) -> DataFrame:
    """Messages and estimated bytes waiting in each range."""
    records = F.col("end_offset") - F.col("start_offset")
    return ranges.select(
        *_PARTITION,
        "start_offset",
        "end_offset",
        records.alias("records"),
        (records * MESSAGE_BYTES).alias("estimated_bytes"),
    )

