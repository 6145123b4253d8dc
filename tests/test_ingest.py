"""Batch and streaming runs over small topics, with restarts and failures."""

import pytest
from pyspark.sql import functions as F

from topicwright import (
    BatchIngest,
    OffsetError,
    RecordShape,
    StreamStart,
    TrackedIngest,
    open_topic,
    publish,
    read_offsets,
    save_offsets,
    start_ingest,
    stream_publish,
    to_messages,
)
from topicwright.streaming import ingest as streaming

FIELDS = "id bigint, first string, last string"
RUN_1 = [(1, "ada", "stone"), (2, "bo", "rivers"), (3, "cy", "meadow")]
RUN_2 = [(4, "ada", "stone"), (5, "bo", "rivers"), (6, "ed", "stone")]
ONCE = {"availableNow": True}


@pytest.fixture
def log(spark, tmp_path):
    return open_topic(spark, f"{tmp_path}/log")


@pytest.fixture
def shape(spark):
    return RecordShape(FIELDS, format="csv")


def send(log, rows, topic="users", partitions=1):
    frame = log.spark.createDataFrame(rows, FIELDS).coalesce(1)
    publish(to_messages(frame, topic, columns=["id", "first", "last"], arrival="id"), log, partitions)


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_batch_runs_continue(log, shape, tmp_path):
    seen = []
    folder = f"{tmp_path}/state"

    def run(**more):
        ingest = BatchIngest(log, "users", shape, offset_folder=folder, namespace="ns", pipeline="p", **more)
        ingest.run(lambda rows: seen.append(ids(rows)))
        return read_offsets(log.spark, f"{folder}/ns.p.offsets.json")

    send(log, RUN_1)
    assert run() == {0: 3}
    send(log, RUN_2)
    assert run(max_records=2) == {0: 5}
    assert run() == {0: 6}
    assert run() == {0: 6}
    assert seen == [[1, 2, 3], [4, 5], [6], []]


def test_batch_initial_offsets_are_inclusive(log, shape, tmp_path):
    send(log, [(0, "a", "b"), *RUN_1])
    ingest = BatchIngest(log, "users", shape, initial_offsets={0: 2}, offset_folder=f"{tmp_path}/state")
    assert ids(ingest.rows()) == [2, 3]
    ingest.commit()
    again = BatchIngest(log, "users", shape, initial_offsets={0: 2}, offset_folder=f"{tmp_path}/state")
    assert ids(again.rows()) == []


def test_failed_batch_and_preview_save_nothing(log, shape, tmp_path):
    send(log, RUN_1)
    folder = f"{tmp_path}/state"

    def fail(_):
        raise RuntimeError("no")

    ingest = BatchIngest(log, "users", shape, offset_folder=folder)
    with pytest.raises(RuntimeError):
        ingest.run(fail)
    BatchIngest(log, "users", shape, offset_folder=folder, preview=True).run(ids)
    assert read_offsets(log.spark, ingest.state_path) is None


def test_batch_reads_only_its_topic_and_partitions(log, shape):
    send(log, RUN_1, partitions=2)
    send(log, RUN_2, topic="other", partitions=2)
    assert ids(BatchIngest(log, "users", shape).rows()) == [1, 2, 3]
    assert ids(BatchIngest(log, "users", shape, partitions=[1, 7]).rows()) == [1, 3]
    assert ids(BatchIngest(log, "nothing", shape).rows()) == []


def test_lost_messages_fail_the_run(log, shape, tmp_path):
    send(log, RUN_1)
    send(log, RUN_2)
    whole = log.rows().cache()
    holey = open_topic(log.spark, f"{tmp_path}/holey")
    whole.filter("offset != 4").write.partitionBy("topic", "partition", "segment").parquet(holey.path)
    with pytest.raises(OffsetError, match="holds 5 messages for offsets 0 to 6"):
        BatchIngest(holey, "users", shape).rows()
    assert ids(BatchIngest(holey, "users", shape, allow_gaps=True).rows()) == [1, 2, 3, 4, 6]
    trimmed = open_topic(log.spark, f"{tmp_path}/trimmed")
    whole.filter("offset >= 2").write.partitionBy("topic", "partition", "segment").parquet(trimmed.path)
    assert ids(BatchIngest(trimmed, "users", shape).rows()) == [3, 4, 5, 6]
    with pytest.raises(OffsetError, match="no longer there"):
        BatchIngest(trimmed, "users", shape, initial_offsets={0: 1}).rows()


def stream(log, shape, tmp_path, start, max_files=None):
    start_ingest(
        log, "users", shape, f"{tmp_path}/out", f"{tmp_path}/checkpoint", start, ONCE, max_files
    ).awaitTermination()
    return ids(log.spark.read.schema(FIELDS).parquet(f"{tmp_path}/out"))


def test_stream_from_beginning_and_restart(log, shape, tmp_path):
    send(log, RUN_1)
    assert stream(log, shape, tmp_path, StreamStart("beginning")) == [1, 2, 3]
    send(log, [(4, "fay", "lake"), (5, "gus", "wood")])
    assert stream(log, shape, tmp_path, StreamStart("beginning"), max_files=1) == [1, 2, 3, 4, 5]
    assert stream(log, shape, tmp_path, StreamStart("beginning")) == [1, 2, 3, 4, 5]


def test_stream_from_latest_skips_nothing_after_a_restart(log, shape, tmp_path):
    send(log, [(0, "hal", "field")])
    assert stream(log, shape, tmp_path, StreamStart("latest")) == []
    send(log, RUN_1)
    assert stream(log, shape, tmp_path, StreamStart("latest")) == [1, 2, 3]


def test_stream_from_latest_of_an_empty_topic(log, shape, tmp_path):
    send(log, RUN_2, topic="other")
    assert stream(log, shape, tmp_path, StreamStart()) == []
    send(log, RUN_1)
    assert stream(log, shape, tmp_path, StreamStart()) == [1, 2, 3]


@pytest.mark.parametrize("literal_ranges", [200, 0])
def test_stream_from_specific_offset(log, shape, tmp_path, monkeypatch, literal_ranges):
    monkeypatch.setattr(streaming, "LITERAL_RANGES", literal_ranges)
    send(log, RUN_1)
    assert stream(log, shape, tmp_path, StreamStart("specific", 2)) == [3]


def test_stream_overrides_and_partitions(log, shape, tmp_path):
    send(log, RUN_1 + RUN_2, partitions=3)
    start = StreamStart("latest", overrides={0: 1, 1: -2, 2: 0}, partitions=[0, 1])
    assert stream(log, shape, tmp_path, start) == [1, 4, 6]


def test_stream_batch_time(log, spark, tmp_path):
    send(log, RUN_1)
    shape = RecordShape(f"t bigint, {FIELDS}, o bigint", format="csv", time_field="t", offset_field="o")
    start_ingest(log, "users", shape, f"{tmp_path}/out", f"{tmp_path}/c", StreamStart("beginning"), ONCE).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.o for r in rows) == [0, 1, 2] and len({r.t for r in rows}) == 1


def tracked(log, shape, tmp_path, write=None, **more):
    def to_folder(rows, tick):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/out/tick={tick}")

    more.setdefault("start", StreamStart("beginning"))
    return TrackedIngest(log, "users", shape, write or to_folder, f"{tmp_path}/source.users", **more)


def output(log, tmp_path):
    return ids(log.spark.read.parquet(f"{tmp_path}/out"))


def test_saved_state_replaces_the_start(log, shape, tmp_path):
    send(log, RUN_1)
    save_offsets(log.spark, f"{tmp_path}/source.users", {0: 1})
    assert tracked(log, shape, tmp_path).drain() == 1
    assert output(log, tmp_path) == [2, 3]
    assert open(f"{tmp_path}/source.users.versions/000000000002").read() == '{"partitionOffsets":{"0":3}}'
    assert not tracked(log, shape, tmp_path).tick()


def test_saved_state_out_of_range_fails(log, shape, tmp_path):
    send(log, RUN_1)
    save_offsets(log.spark, f"{tmp_path}/source.users", {0: 4})
    with pytest.raises(OffsetError, match="Cannot resume from the saved offsets"):
        tracked(log, shape, tmp_path).tick()


def test_failed_tick_saves_no_state_and_is_read_again(log, shape, tmp_path):
    send(log, RUN_1 + RUN_2)
    good = tracked(log, shape, tmp_path, rate=2)

    def flaky(rows, tick):
        good.write(rows, tick)
        if tick == 2:
            raise RuntimeError("after writing")

    failing = tracked(log, shape, tmp_path, flaky, rate=2)
    with pytest.raises(RuntimeError):
        failing.drain()
    assert read_offsets(log.spark, f"{tmp_path}/source.users") == {0: 2}
    failing.write = good.write
    assert failing.drain() == 2
    assert output(log, tmp_path) == [1, 2, 3, 4, 5, 6]


def test_nothing_read_saves_nothing(log, shape, tmp_path):
    send(log, RUN_1)
    ingest = tracked(log, shape, tmp_path, start=StreamStart("latest"))
    assert not ingest.tick()
    assert read_offsets(log.spark, f"{tmp_path}/source.users") is None
    send(log, RUN_2)
    assert ingest.drain() == 1
    assert output(log, tmp_path) == [4, 5, 6]


def test_new_partition_starts_at_its_earliest(log, shape, tmp_path):
    send(log, RUN_1)
    ingest = tracked(log, shape, tmp_path, start=StreamStart("latest"))
    assert not ingest.tick()
    send(log, RUN_2, partitions=2)
    ingest.drain()
    assert output(log, tmp_path) == [4, 5, 6]
    assert read_offsets(log.spark, f"{tmp_path}/source.users") == {0: 5, 1: 1}


@pytest.mark.parametrize("rate, interval, ticks", [(0, 1, 1), (1, 2, 3), (4, 0.5, 3), (1000, 1, 1)])
def test_rate_cap(log, shape, tmp_path, rate, interval, ticks):
    send(log, RUN_1 + RUN_2)
    assert tracked(log, shape, tmp_path, rate=rate, interval_seconds=interval).drain() == ticks
    assert output(log, tmp_path) == [1, 2, 3, 4, 5, 6]


def test_negative_rate_is_rejected(log, shape, tmp_path):
    with pytest.raises(ValueError, match="must not be negative"):
        tracked(log, shape, tmp_path, rate=-1)


def test_ticking_query(log, shape, tmp_path):
    send(log, RUN_1 + RUN_2)
    ingest = tracked(log, shape, tmp_path, rate=3, interval_seconds=1)
    query = ingest.start_stream(f"{tmp_path}/clock")
    try:
        for _ in range(60):
            if query.awaitTermination(1) or read_offsets(log.spark, f"{tmp_path}/source.users") == {0: 6}:
                break
    finally:
        query.stop()
    assert output(log, tmp_path) == [1, 2, 3, 4, 5, 6]


def test_failing_tick_ends_the_query(log, shape, tmp_path):
    send(log, RUN_1)

    def fail(rows, tick):
        raise RuntimeError("failing batch")

    query = tracked(log, shape, tmp_path, fail).start_stream(f"{tmp_path}/clock")
    with pytest.raises(Exception, match="failing batch"):
        query.awaitTermination(60)
    assert read_offsets(log.spark, f"{tmp_path}/source.users") is None


def test_stream_publish_round_trip(log, shape, tmp_path):
    send(log, RUN_1)
    target = open_topic(log.spark, f"{tmp_path}/target")
    rows = log.stream(max_files=1).select(F.col("value").cast("string").alias("line"), "offset")
    messages = to_messages(rows, "copy", columns=["line"], arrival="offset")
    for extra in (RUN_2, []):
        stream_publish(messages, target, f"{tmp_path}/c", 2, ONCE).awaitTermination()
        if extra:
            send(log, extra)
    assert ids(BatchIngest(target, "copy", shape).rows()) == [1, 2, 3, 4, 5, 6]
