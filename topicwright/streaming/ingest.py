"""Topics as streams: decoding with Spark's checkpoint, or with offsets of our own."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicwright.functions.shape import RecordShape
from topicwright.operators.decode import decode_topic
from topicwright.operators.islands import PackedIntervals, collect_packed, outside
from topicwright.operators.offsets import (
    apply_overrides,
    batch_start,
    check_saved,
    collect_offsets,
    offset_table,
    resolve_sentinels,
    resume_offsets,
    select_partitions,
    start_policy,
)
from topicwright.operators.ranges import (
    BROADCAST_RANGES,
    LITERAL_RANGES,
    OffsetRange,
    check_whole,
    collect_ranges,
    from_known_segments,
    plan_ranges,
    segment_number,
)
from topicwright.operators.state import State, read_state, save_state

# Fixed value: messages a second and partition that a tick reads unless told otherwise.
TICK_RATE = 1000


@dataclass
class StreamStart:
    """Where a stream starts: a policy for all partitions and offsets for some of them."""

    policy: str | None = None
    specific: int | None = None
    overrides: Mapping[int, int] = field(default_factory=dict)
    partitions: Iterable[int] = ()

    def offsets(self, source, topic: str, bounds: DataFrame) -> DataFrame:
        """Real start offset of each partition."""
        starts = start_policy(bounds, self.policy, self.specific)
        starts = apply_overrides(starts, offset_table(source.spark, topic, self.overrides))
        return resolve_sentinels(starts, bounds)


def stream_from(stream: DataFrame, topic: str, starts: Mapping[int, int], partitions: Iterable[int] = ()) -> DataFrame:
    """Messages of a topic stream from the start offsets on.

    Partitions that were not there when the stream was first started are read whole.
    """
    rows = select_partitions(stream.filter(F.col("topic") == topic), partitions)
    segments = "segment" in stream.columns
    if len(starts) > LITERAL_RANGES:
        if segments:
            rows = rows.filter(from_known_segments({(topic, p): offset for p, offset in starts.items()}))
        table = offset_table(stream.sparkSession, topic, starts).withColumnRenamed("offset", "first")
        if len(starts) <= BROADCAST_RANGES:
            table = F.broadcast(table)
        joined = rows.join(table, ["topic", "partition"], "left")
        return joined.filter(F.col("offset") >= F.coalesce("first", F.lit(0))).select(*stream.columns)
    keep = ~F.col("partition").isin(sorted(starts)) if starts else F.lit(True)
    for partition, offset in sorted(starts.items()):
        later = F.col("offset") >= offset
        if segments:
            later = later & (F.col("segment") >= segment_number(offset))
        keep = keep | ((F.col("partition") == partition) & later)
    return rows.filter(keep)


def _first_start(spark, checkpoint: str, resolve: Callable[[], State]) -> State:
    """Start offsets that stay the same for all starts with one checkpoint."""
    place = f"{checkpoint.rstrip('/')}/first-offsets.json"
    first = read_state(spark, place)
    if first is None:
        start = resolve()
        first = save_state(spark, place, None, start.offsets, start.ahead, start.first_batch)
    return first


def start_ingest(
    source,
    topic: str,
    shape: RecordShape,
    output: str,
    checkpoint: str,
    start: StreamStart = StreamStart(),
    trigger: Mapping[str, object] | None = None,
    max_files: int | None = None,
    rate: int | None = None,
    interval_seconds: float = 1.0,
) -> StreamingQuery:
    """Decode a topic into Parquet, each message exactly once.

    Spark's checkpoint remembers what was read. The start offsets are fixed beside
    it at the first start, so that a restart from ``latest`` skips nothing. ``rate`` is the number of messages a second and partition
    at most on average (0: no cap). Unless told otherwise a live topic is read at 1000, a table without a cap. A table is
    read by whole files, ``max_files`` a batch or as many as the rate's share of bytes allows.
    """

    def resolve() -> State:
        return State(collect_offsets(start.offsets(source, topic, source.bounds(topic))))

    starts = _first_start(source.spark, checkpoint, resolve).offsets
    cap = source.rate_options(rate, interval_seconds, len(starts), topic)
    messages = stream_from(source.stream(topic, starts, max_files, cap), topic, starts, start.partitions)
    return (
        decode_topic(messages, shape)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def stream_publish(
    messages: DataFrame,
    target,
    checkpoint: str,
    partitions: int | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Publish each micro-batch of a message stream, at least once."""
    known = {}

    def publish_batch(batch: DataFrame, _: int) -> None:
        known.update(target.append(batch, partitions, known))

    return (
        messages.writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


@dataclass
class TrackedIngest:
    """Reads a topic on from offsets in a state file, which is saved after each batch that was written.

    ``start_stream`` runs it as a stream. ``tick`` reads one planned range of each partition, with exactly
    ``rate`` records a second and partition at most (1000 unless told otherwise; 0: no cap). Either hands the rows to ``write`` and then
    saves where they ended. A batch that fails saves nothing and is read again: ``write`` gets the same id
    then, so writing to a place named after it keeps the output free of duplicates. Null keys and
    values stay null, as in any stream. Two runs that save to one state file at a time don't overwrite each other: the second to save fails.

    ``written`` gives the rows written so far, with the shape's partition and offset fields (or None if there is nothing). A stream
    with a new checkpoint then leaves out what was written but not yet saved, and its batches get new ids.
    """

    source: object
    topic: str
    shape: RecordShape
    write: Callable[[DataFrame, int], None]
    state_path: str
    start: StreamStart = field(default_factory=StreamStart)
    rate: int | None = None
    interval_seconds: float = 1.0
    allow_gaps: bool = False
    max_files: int | None = None
    written: Callable[[], DataFrame | None] | None = None
    _position: dict[int, int] | None = field(default=None, init=False, repr=False)
    _saved: State | None = field(default=None, init=False, repr=False)

    def __post_init__(self):
        if self.rate is not None and self.rate < 0:
            raise ValueError(f"The rate per partition must not be negative, but is {self.rate}.")
        if self.written and not (self.shape.partition_field and self.shape.offset_field):
            raise ValueError("Leaving out written rows needs a partition and an offset field.")

    def plan(self) -> list[OffsetRange]:
        """Ranges of the next tick: from where the last one ended, or else from the saved state."""
        spark = self.source.spark
        known = {(self.topic, p): offset for p, offset in (self._position or {}).items()}
        bounds = self.source.bounds(self.topic, known)
        if self._position is None:
            self._position = self._resolved()
        bounds = select_partitions(bounds, self.start.partitions)
        # Partitions that are new since the last tick are read from their earliest offset.
        position = offset_table(spark, self.topic, self._position)
        starts = batch_start(bounds, offset_table(spark, self.topic, {}), position)
        rate = TICK_RATE if self.rate is None else self.rate
        cap = max(1, int(rate * self.interval_seconds)) if rate else None
        ranges = collect_ranges(plan_ranges(starts, bounds, cap))
        if not self.allow_gaps:
            check_whole(ranges, bounds, self.source.dense)
        return ranges

    def tick(self) -> bool:
        """Run one tick; false if there was nothing to read, in which case nothing is saved."""
        ranges = self.plan()
        if all(r.start_offset >= r.end_offset for r in ranges):
            return False
        # All partitions count, also those without anything to read: the id only ever grows.
        tick_id = sum(({r.partition: r.start_offset for r in ranges} | self._position).values())
        batch_time = F.lit(int(time.time() * 1000))
        self.write(decode_topic(self.source.read(ranges), self.shape, batch_time, keep_nulls=True), tick_id)
        ends = {r.partition: r.end_offset for r in ranges}
        ahead = PackedIntervals.of(self._saved.ahead).advanced(ends)[1] if self._saved else {}
        self._saved = save_state(self.source.spark, self.state_path, self._saved, ends, ahead)
        self._position.update(ends)
        return True

    def drain(self) -> int:
        """Tick until the topic is read up; returns the number of ticks."""
        ticks = 0
        while self.tick():
            ticks += 1
        return ticks

    def start_stream(self, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
        """Read on as a stream: each micro-batch is written, then its end is saved.

        The state file decides where a new checkpoint starts; a checkpoint that is there goes on
        with what it has not read. Files of one partition may come in any order and hold any of its offsets: the offset
        saved is the one up to which all were read, and runs of offsets read beyond it are saved beside it until the gap is closed.
        """
        spark = self.source.spark
        first = _first_start(spark, checkpoint, self._first_state)
        self._saved = read_state(spark, self.state_path)
        saved = self._saved or State()
        position = dict(first.offsets) | {p: max(o, first.offsets.get(p, 0)) for p, o in saved.offsets.items()}
        progress = replace(first, offsets=position, ahead=PackedIntervals.of(saved.ahead).united(PackedIntervals.of(first.ahead)))
        cap = self.source.rate_options(self.rate, self.interval_seconds, len(first.offsets), self.topic)
        stream = self.source.stream(self.topic, first.offsets, self.max_files, cap)

        def batch(rows: DataFrame, batch_id: int) -> None:
            nonlocal progress
            rows = outside(rows, first.ahead).persist()
            try:
                if self.source.dense:
                    found = collect_packed(rows)
                else:
                    ends = rows.groupBy("partition").agg(F.min("offset"), F.max("offset") + 1).collect()
                    found = {partition: [(low, end)] for partition, low, end in ends}
                batch_time = F.lit(int(time.time() * 1000))
                self.write(decode_topic(rows, self.shape, batch_time, keep_nulls=True), first.first_batch + batch_id)
            finally:
                rows.unpersist()
            if not found:
                return
            offsets, ahead = progress.offsets, progress.ahead
            if self.source.dense:
                offsets, ahead = ahead.united(found).advanced(offsets, found)
            else:
                # Compaction and transactions leave gaps that are never filled.
                offsets = offsets | {partition: spans[-1][1] for partition, spans in found.items()}
            reached = {p: offsets.get(p, 0) for p in found}
            self._saved = save_state(spark, self.state_path, self._saved, reached, ahead)
            progress = replace(progress, offsets=offsets, ahead=ahead)

        messages = stream_from(stream, self.topic, first.offsets, self.start.partitions)
        return (
            messages.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{self.interval_seconds} seconds"}))
            .start()
        )

    def _first_state(self) -> State:
        """Where a new checkpoint starts, which offsets beyond are written already, and the ids of its batches."""
        offsets = self._resolved()
        if self.written is None:
            return State(offsets)
        ahead = PackedIntervals.of(self._saved.ahead if self._saved else {})
        rows = self.written()
        if rows is not None:
            names = {self.shape.partition_field: "partition", self.shape.offset_field: "offset"}
            placed = rows.select(*[F.col(f"`{name}`").alias(kind) for name, kind in names.items()])
            beyond = stream_from(placed.withColumn("topic", F.lit(self.topic)), self.topic, offsets)
            ahead = ahead.united(collect_packed(beyond))
        # Batches of an earlier checkpoint keep their places: ids start from the time of this one.
        known = self._saved is not None or bool(ahead)
        return State(offsets, ahead, int(time.time()) << 24 if known else 0)

    def _resolved(self) -> dict[int, int]:
        """Where to start: the saved state, or else what was configured."""
        spark = self.source.spark
        bounds = self.source.bounds(self.topic)
        self._saved = read_state(spark, self.state_path)
        saved = offset_table(spark, self.topic, self._saved.offsets if self._saved else {})
        check_saved(saved, bounds)
        chosen = select_partitions(bounds, self.start.partitions)
        return collect_offsets(resume_offsets(self.start.offsets(self.source, self.topic, chosen), saved, chosen))
