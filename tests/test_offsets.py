import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicwright import (
    EARLIEST,
    LATEST,
    OffsetError,
    OffsetRange,
    apply_overrides,
    backlog,
    batch_start,
    check_saved,
    collect_ranges,
    offset_bounds,
    offset_table,
    plan_ranges,
    read_offsets,
    read_ranges,
    resolve_sentinels,
    resume_offsets,
    save_offsets,
    saved_offset_problems,
    select_partitions,
    start_policy,
)
from topicwright.operators import ranges as ranges_module
from topicwright.operators.offsets import bounds_table
from topicwright.operators.ranges import check_whole


def bounds(spark, **partitions):
    rows = [("t", int(p[1:]), e, l, l - e) for p, (e, l) in partitions.items()]
    return bounds_table(spark, rows)


def as_map(frame):
    return {row.partition: row.offset for row in frame.collect()}


def table(spark, offsets):
    return offset_table(spark, "t", offsets)


@pytest.fixture(scope="module")
def log(spark):
    return spark.range(400).select(
        F.lit("t").alias("topic"),
        (F.col("id") % 4).cast("int").alias("partition"),
        (F.col("id") / 4).cast("bigint").alias("offset"),
        F.lit(b"k").alias("key"),
        F.col("id").cast("string").cast("binary").alias("value"),
    )


def test_bounds_end_is_exclusive(log):
    assert {tuple(r) for r in offset_bounds(log).collect()} == {("t", p, 0, 100, 100) for p in range(4)}


def test_start_policies(spark):
    known = bounds(spark, p0=(3, 9))
    assert as_map(start_policy(known, "beginning")) == {0: EARLIEST}
    assert as_map(start_policy(known, "latest")) == {0: LATEST}
    assert as_map(start_policy(known)) == {0: LATEST}
    assert as_map(start_policy(known, "specific", 5)) == {0: 5}
    assert as_map(start_policy(known, None, 6)) == {0: 6}
    with pytest.raises(OffsetError):
        start_policy(known, "specific")
    with pytest.raises(OffsetError):
        start_policy(known, "sometime")


def test_overrides_and_sentinels(spark):
    known = bounds(spark, p0=(3, 9), p1=(0, 5), p2=(0, 0))
    starts = apply_overrides(start_policy(known, "beginning"), table(spark, {1: LATEST, 2: 4, 7: 1}))
    assert as_map(starts) == {0: EARLIEST, 1: LATEST, 2: 4}
    assert as_map(resolve_sentinels(starts, known)) == {0: 3, 1: 5, 2: 4}


def test_sentinel_without_bounds_fails(spark):
    with pytest.raises(PySparkException, match="No offsets known for topic t, partition 5"):
        resolve_sentinels(table(spark, {5: EARLIEST}), bounds(spark, p0=(0, 1))).collect()


def test_batch_start_prefers_saved_then_configured(spark):
    known = bounds(spark, p0=(3, 9), p1=(0, 5), p2=(1, 5))
    starts = batch_start(known, table(spark, {0: 4, 1: 2}), table(spark, {0: 8}))
    assert as_map(starts) == {0: 8, 1: 2, 2: 1}


def test_negative_batch_start_fails(spark):
    with pytest.raises(PySparkException, match="No valid start offset for topic t, partition 0"):
        batch_start(bounds(spark, p0=(0, 9)), table(spark, {0: EARLIEST}), table(spark, {})).collect()


@pytest.mark.parametrize("cap, end", [(None, 9), (-1, 9), (0, 9), (2, 5), (100, 9)])
def test_cap(spark, cap, end):
    known = bounds(spark, p0=(3, 9))
    ranges = plan_ranges(table(spark, {0: 3}), known, cap)
    assert collect_ranges(ranges) == [OffsetRange("t", 0, 3, end)]


def test_resume(spark):
    known = bounds(spark, p0=(3, 9), p1=(2, 5))
    starts = table(spark, {0: 9, 1: 5})
    assert as_map(resume_offsets(starts, table(spark, {}), known)) == {0: 9, 1: 5}
    # A partition that is newer than the saved state starts at its earliest offset.
    assert as_map(resume_offsets(starts, table(spark, {0: 4}), known)) == {0: 4, 1: 2}


@pytest.mark.parametrize(
    "offset, earliest, latest, valid",
    [(100, 0, 202, True), (102, 0, 200, True), (100, 0, 10, False), (102, 0, 0, False),
     (5, 5, 9, True), (9, 5, 9, True), (4, 5, 9, False), (10, 5, 9, False)],
)
def test_saved_offset_limits(spark, offset, earliest, latest, valid):
    problems = saved_offset_problems(table(spark, {0: offset}), bounds(spark, p0=(earliest, latest)))
    assert problems.isEmpty() == valid


def test_saved_offset_message_lists_every_problem(spark):
    known = bounds(spark, p0=(0, 10), p1=(0, 20), p2=(0, 5))
    with pytest.raises(OffsetError) as error:
        check_saved(table(spark, {0: 100, 1: 20, 2: 6, 4: 0}), known)
    assert str(error.value).splitlines() == [
        "Cannot resume from the saved offsets:",
        "Offset 100, saved for topic t, partition 0, is outside its range 0 to 10.",
        "Offset 6, saved for topic t, partition 2, is outside its range 0 to 5.",
        "Offset 0, saved for topic t, partition 4, belongs to no known partition.",
    ]
    check_saved(table(spark, {0: 10, 1: 0}), known)


def test_select_partitions(log):
    assert {r.partition for r in select_partitions(log, [1, 3, 99]).collect()} == {1, 3}
    assert select_partitions(log, []).count() == 400


RANGES = [OffsetRange("t", 0, 5, 8), OffsetRange("t", 1, 7, 7), OffsetRange("t", 2, 9, 4), OffsetRange("t", 3, 99, 200)]


@pytest.mark.parametrize("literal_ranges, broadcast_ranges", [(200, 10), (0, 10), (0, 0)])
def test_read_ranges_is_half_open(log, monkeypatch, literal_ranges, broadcast_ranges):
    monkeypatch.setattr(ranges_module, "LITERAL_RANGES", literal_ranges)
    monkeypatch.setattr(ranges_module, "BROADCAST_RANGES", broadcast_ranges)
    rows = read_ranges(log, RANGES)
    assert rows.columns == log.columns
    assert sorted((r.partition, r.offset) for r in rows.collect()) == [(0, 5), (0, 6), (0, 7), (3, 99)]


def test_no_ranges_read_nothing(log):
    assert read_ranges(log, []).count() == 0


def test_ranges_must_be_whole(spark):
    known = bounds_table(spark, [("t", 0, 5, 10, 5), ("t", 1, 0, 10, 9), ("t", 2, 0, 4, 4)])
    check_whole([OffsetRange("t", 0, 5, 10), OffsetRange("t", 1, 10, 10), OffsetRange("t", 2, 9, 4)], known)
    with pytest.raises(OffsetError, match="Offsets 4 to 5 of topic t, partition 0 are no longer there"):
        check_whole([OffsetRange("t", 0, 4, 10)], known)
    with pytest.raises(OffsetError, match="partition 1 holds 9 messages for offsets 0 to 10"):
        check_whole([OffsetRange("t", 1, 0, 5)], known)
    check_whole([OffsetRange("t", 1, 0, 5)], known, dense=False)


def test_backlog(spark):
    known = bounds(spark, p0=(0, 100), p1=(0, 100), p2=(0, 0), p3=(0, 1))
    plan = plan_ranges(table(spark, {0: 40, 1: 0, 2: 0, 3: 0}), known)
    sizes = {r.partition: (r.records, r.estimated_bytes) for r in backlog(plan).collect()}
    assert sizes == {0: (60, 61440), 1: (100, 102400), 2: (0, 0), 3: (1, 1024)}


def test_state_round_trip_and_merge(spark, tmp_path):
    path = f"{tmp_path}/folder/a.offsets.json"
    assert read_offsets(spark, path) is None
    save_offsets(spark, path, {0: 3, 11: 7})
    save_offsets(spark, path, {0: 5, 2: 1})
    assert read_offsets(spark, path) == {0: 5, 2: 1, 11: 7}
    assert open(f"{path}.versions/000000000002").read() == '{"partitionOffsets":{"0":5,"2":1,"11":7}}'
    held = [p.name for p in (tmp_path / "folder" / "a.offsets.json.versions").iterdir() if not p.name.endswith(".crc")]
    assert sorted(held) == ["000000000001", "000000000002"]


@pytest.mark.parametrize("text", ["", "{", "[]", "{}", '{"partitionOffsets":{"x":1}}', '{"partitionOffsets":null}'])
def test_malformed_state_fails(spark, tmp_path, text):
    path = tmp_path / "bad.offsets.json"
    path.write_text(text)
    with pytest.raises(OffsetError):
        read_offsets(spark, str(path))
