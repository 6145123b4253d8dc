"""Segment folders: small ones here, so that ranges and appends cross them."""

import pytest
from pyspark.sql import functions as F

from topicwright import (
    BatchIngest,
    OffsetRange,
    RecordShape,
    StreamStart,
    TrackedIngest,
    collect_ranges,
    earliest_offsets,
    open_topic,
    plan_ranges,
    publish,
    sample_topic,
    to_messages,
)
from topicwright.operators import ranges
from topicwright.operators.ranges import from_known_segments


@pytest.fixture
def small_segments(monkeypatch):
    monkeypatch.setattr(ranges, "SEGMENT_BITS", 3)


def send(log, low, high, partitions):
    rows = log.spark.range(low, high).select("id")
    publish(to_messages(rows, "t", columns=["id"], arrival="id"), log, partitions)


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [2, 40])
def test_layout_and_reads(spark, tmp_path, small_segments, partitions):
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 500, partitions)
    send(log, 500, 1000, partitions)
    rows = log.rows()
    assert rows.filter(F.col("segment") != F.floor(F.col("offset") / 8)).count() == 0
    found = {(r.partition, r.offset): int(bytes(r.value)) for r in rows.collect()}
    assert found == {(i % partitions, i // partitions): i for i in range(1000)}
    per_partition = 1000 // partitions
    wanted = [OffsetRange("t", p, 7, 17) for p in range(partitions)]
    some = log.read(wanted)
    assert some.count() == partitions * (min(17, per_partition) - 7)
    assert len(some.inputFiles()) <= len(rows.inputFiles())


def test_range_reads_open_only_their_segments(spark, tmp_path, small_segments):
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 400, 2)
    narrow = log.read([OffsetRange("t", 1, 40, 44)])
    assert [r.offset for r in narrow.orderBy("offset").collect()] == [40, 41, 42, 43]
    assert "segment" in plan_text(narrow).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [r.message for r in sample_topic(log, "t", 3).collect()] == ["0", "2", "4"]


def test_known_offsets_skip_old_segments(spark, tmp_path, small_segments):
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 64, 2)
    send(log, 100, 101, 4)
    assert {tuple(b) for b in log.bounds().collect()} == {("t", 0, 0, 33, 33), ("t", 1, 0, 32, 32)}
    known = {("t", 0): 17, ("t", 1): 32}
    assert {tuple(b) for b in log.bounds(known=known).collect()} == {("t", 0, 16, 33, 17)}
    publish(to_messages(spark.range(5), "u", columns=["id"], arrival="id"), log, 1)
    assert ("u", 0, 0, 5, 5) in {tuple(b) for b in log.bounds(known=known).collect()}
    wanted = {("t", 0, 16, 33, 17), ("u", 0, 0, 5, 5)}
    assert {tuple(b) for b in log.bounds(known=known).collect()} == wanted


@pytest.mark.parametrize("known_partitions", [1, 200, 201, 1000])
def test_a_new_partition_of_a_known_topic_is_found(spark, small_segments, known_partitions):
    """Whatever the number of known partitions, one that is new in the topic passes, and old segments do not."""
    known = {("t", p): 40 + 16 * (p % 7) for p in range(known_partitions)}
    places = spark.createDataFrame([("t", p, s) for p in (0, known_partitions) for s in range(12)] + [("u", 0, 0)], "topic string, partition int, segment long")
    found = {tuple(r) for r in places.filter(from_known_segments(known)).collect()}
    assert found == {("t", known_partitions, s) for s in range(12)} | {("t", 0, s) for s in range(5, 12)} | {("u", 0, 0)}


def test_ranges_of_many_partitions_open_only_their_segments(spark, tmp_path, small_segments, monkeypatch):
    """One partition lags behind all others: only its old segments are opened."""
    monkeypatch.setattr(ranges, "LITERAL_RANGES", 3)
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 640, 8)
    lagging = [OffsetRange("t", 0, 0, 80), *(OffsetRange("t", p, 79, 80) for p in range(1, 8))]
    rows = log.read(lagging)
    assert rows.count() == 87
    assert len(rows.select(F.input_file_name()).distinct().collect()) == 10 + 7
    opened = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in opened and "segment" in opened.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_append_returns_what_it_has_written(spark, tmp_path, small_segments):
    log = open_topic(spark, f"{tmp_path}/log")
    messages = to_messages(spark.range(10), "t", columns=["id"], arrival="id")
    first = log.append(messages, 2)
    assert first == {("t", 0): 5, ("t", 1): 5}
    second = log.append(to_messages(spark.range(9), "t", columns=["id"], arrival="id"), 3, first)
    assert second == {("t", 0): 8, ("t", 1): 8, ("t", 2): 3}
    log.append(to_messages(spark.range(6), "t", columns=["id"], arrival="id"), 3, second)
    placed = [(r.partition, r.offset) for r in log.rows().collect()]
    assert len(set(placed)) == len(placed) == 25


def test_repeated_arrivals_fail(spark, tmp_path):
    log = open_topic(spark, f"{tmp_path}/log")
    rows = spark.createDataFrame([(1,), (2,), (2,)], "id bigint")
    with pytest.raises(Exception, match="Twice the same arrival: 2"):
        log.append(to_messages(rows, "t", arrival="id"), 1)


def test_append_with_known_offsets(spark, tmp_path, small_segments):
    log = open_topic(spark, f"{tmp_path}/log")
    known = {}
    for low in range(0, 48, 16):
        messages = to_messages(spark.range(low, low + 16), "t", columns=["id"], arrival="id")
        known |= log.append(messages, 2, known)
    found = {(r.partition, r.offset): int(bytes(r.value)) for r in log.rows().collect()}
    assert found == {(i % 2, i // 2): i for i in range(48)}


def test_ticks_across_segments(spark, tmp_path, small_segments):
    log = open_topic(spark, f"{tmp_path}/log")
    # Partition 0 ends exactly at a segment, partition 1 goes on.
    publish(to_messages(spark.range(0, 32, 2).select("id"), "t", columns=["id"], arrival="id"), log, 2)
    publish(to_messages(spark.range(1, 99, 2).select("id"), "t", columns=["id"], arrival="id"), log, 2)
    ticks = []

    def write(rows, tick):
        ticks.append(tick)
        rows.write.mode("overwrite").parquet(f"{tmp_path}/out/tick={tick}")

    shape = RecordShape("id bigint", format="csv")
    ingest = TrackedIngest(log, "t", shape, write, f"{tmp_path}/state", StreamStart("beginning"), rate=8)
    ingest.drain()
    assert len(set(ticks)) == len(ticks) == 7 and ticks == sorted(ticks)
    written = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert written == sorted([*range(0, 32, 2), *range(1, 99, 2)])
    assert collect_ranges(plan_ranges(earliest_offsets(log.bounds()), log.bounds()))[0].end_offset == 16
    assert BatchIngest(log, "t", shape).rows().count() == 65
