"""The segment index, blocks by bytes, islands of offsets, and state files of several savers."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from topicwright import (
    OffsetRange,
    RecordShape,
    StateConflict,
    StreamStart,
    TrackedIngest,
    open_topic,
    publish,
    read_offsets,
    read_state,
    save_offsets,
    save_state,
    to_messages,
)
from topicwright.operators import islands, ranges
from topicwright.operators.numbering import blocks_of
from topicwright.sources import segment_index, topic_log
from topicwright.sources.topic_log import LOG_SCHEMA, TopicTable

ONCE = {"availableNow": True}


def shape():
    return RecordShape("p int, o bigint, body binary", partition_field="p", offset_field="o")


@pytest.fixture
def small_segments(monkeypatch):
    monkeypatch.setattr(ranges, "SEGMENT_BITS", 3)


@pytest.fixture
def footers(monkeypatch):
    """Places of the segments whose footers were read."""
    read = []
    plain = segment_index.footer_segments

    def spy(rows, listed):
        found = plain(rows, listed)
        read.extend(s[:3] for s in found)
        return found

    monkeypatch.setattr(segment_index, "footer_segments", spy)
    return read


def send(log, low, high, partitions, topic="t"):
    rows = log.spark.range(low, high).select("id")
    publish(to_messages(rows, topic, columns=["id"], arrival="id"), log, partitions)


def bounds(log, *args):
    return {tuple(b) for b in log.bounds(*args).collect()}


def test_bounds_open_no_file_that_is_known(spark, tmp_path, small_segments, footers):
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 200, 3)
    footers.clear()
    expected = {("t", 0, 0, 67, 67), ("t", 1, 0, 67, 67), ("t", 2, 0, 66, 66)}
    assert bounds(log, "t") == expected == bounds(log) and footers == []
    # A lost index, and one with an outdated entry, change no result.
    stored = segment_index.stored_segments(spark, log.path)
    assert len(stored) == 27 and all(s.bytes > 0 for s in stored)
    shutil.rmtree(f"{log.path}/_segments")
    assert bounds(log, "t") == expected and len(footers) == 27
    segment_index.store_segments(spark, log.path, [s._replace(mark=s.mark + 1, last=99) for s in stored[:5]] + stored[5:])
    footers.clear()
    assert bounds(log, "t") == expected
    assert sorted(footers) == sorted(s[:3] for s in stored[:5])
    # Files that no append has told of.
    extra = spark.createDataFrame([(None, b"x", "t", 0, 67, None, 0, 8)], LOG_SCHEMA)
    extra.write.mode("append").partitionBy("topic", "partition", "segment").parquet(log.path)
    footers.clear()
    assert bounds(log, "t") == expected - {("t", 0, 0, 67, 67)} | {("t", 0, 0, 68, 68)}
    assert ("t", 0, 8) in footers


def test_entries_are_put_together(spark, tmp_path, small_segments, monkeypatch, footers):
    monkeypatch.setattr(segment_index, "MANY_FILES", 3)
    log = open_topic(spark, f"{tmp_path}/log")
    for low in range(0, 50, 10):
        send(log, low, low + 10, 1, "a b")
    files = list((tmp_path / "log" / "_segments" / "topic=a b").glob("*.parquet"))
    assert 0 < len(files) <= 3
    footers.clear()
    assert bounds(log, "a b") == {("a b", 0, 0, 50, 50)} and footers == []


def test_many_ranges_open_exactly_their_files(spark, tmp_path, small_segments, monkeypatch):
    for module in (ranges, topic_log):
        monkeypatch.setattr(module, "LITERAL_RANGES", 10)
    log = open_topic(spark, f"{tmp_path}/log")
    send(log, 0, 800, 20)
    wanted = [OffsetRange("t", p, 7 * p % 35, 7 * p % 35 + 4) for p in range(20)]
    rows = log.read(wanted)
    folders = {(r.partition, s) for r in wanted for s in range(r.start_offset >> 3, ((r.end_offset - 1) >> 3) + 1)}
    opened = segment_index.listed_segments(rows)
    assert {place[1:] for place in opened} == folders
    assert sorted((r.partition, r.offset) for r in rows.collect()) == sorted((r.partition, o) for r in wanted for o in range(*r[2:]))


def test_one_topic_is_listed(spark, tmp_path):
    log = open_topic(spark, f"{tmp_path}/log")
    for topic in ("a", "b", "c d"):
        send(log, 0, 30, 2, topic)
    query = log.stream("c d").writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query.option("checkpointLocation", f"{tmp_path}/check").trigger(**ONCE).start().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30
    sources = "".join(p.read_text() for p in (tmp_path / "check" / "sources" / "0").iterdir() if p.name.isdigit())
    assert "topic=c" in sources and "topic=a" not in sources and "topic=b" not in sources
    assert {place[0] for place in segment_index.listed_segments(log.rows("c d"))} == {"c d"}


@pytest.mark.parametrize("spread", ["dense", "sparse", "clustered", "extreme"])
def test_no_block_is_larger_than_allowed(spark, spread):
    pick = random.Random(spread)
    arrivals = {
        "dense": range(3000),
        "sparse": sorted(pick.sample(range(1 << 60), 3000)),
        "clustered": [*range(1500), *range(1 << 50, (1 << 50) + 1490), *(1 << k for k in range(52, 62))],
        "extreme": sorted({-(1 << 63), (1 << 63) - 1, *pick.sample(range(-100, 10**6), 2998)}),
    }[spread]
    sizes = [min(1 << 20, int(1.5 ** pick.randrange(0, 35))) for _ in arrivals]
    rows = [("hot" if i % 3 else "cold", a, n) for i, (a, n) in enumerate(zip(arrivals, sizes))]
    frame = spark.createDataFrame(rows, "g string, v bigint, n bigint")
    most = 1 << 21
    found = blocks_of(frame, ["g"], "v", F.col("n"), most, 500)
    for group, blocks in found.items():
        own = [(v, n) for g, v, n in rows if g == group[0]]
        assert sum(b.rows for b in blocks) == len(own) and sum(b.bytes for b in blocks) == sum(n for _, n in own)
        for before, after in zip(blocks, blocks[1:]):
            assert before.high < after.low
        for block in blocks:
            inside = [n for v, n in own if block.low <= v <= block.high]
            assert (len(inside), sum(inside)) == (block.rows, block.bytes)
            assert block.rows == 1 or (block.bytes <= most and block.rows <= 500)
        fewest = max(sum(n for _, n in own) / most, len(own) / 500)
        assert len(blocks) <= 4 * fewest + 2
    assert blocks_of(frame.limit(0), ["g"], "v", F.col("n")) == {}


def test_islands(spark, small_segments):
    pick = random.Random(3)
    held = {(p, o) for p in range(3) for o in pick.sample(range(200), 150)} | {(3, o) for o in range(100)}
    rows = spark.createDataFrame([("t", *x) for x in [*held, *list(held)[:40]]], "topic string, partition int, offset bigint")
    expected = set()
    for p, o in held:
        if (p, o - 1) not in held:
            end = o
            while (p, end) in held:
                end += 1
            expected.add(("t", p, o, end))
    found = islands.offset_islands(rows.repartition(5)).collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected
    spans = islands.collect_islands(rows)
    assert {("t", p, a, b) for p, own in spans.items() for a, b in own} == expected
    every = spark.range(230).selectExpr("'t' as topic", "cast(id % 5 as int) as partition", "id div 5 * 5 as offset")
    left = islands.outside(every, spans).collect()
    assert sorted((r.partition, r.offset) for r in left) == sorted((p, o) for p in range(5) for o in range(0, 230, 5) if (p, o) not in held)
    assert islands.advanced({0: 5, 1: 0}, {0: [(3, 9), (12, 14)], 1: [(2, 3)], 2: [(0, 4)]}) == (
        {0: 9, 1: 0, 2: 4}, {0: [(12, 14)], 1: [(2, 3)]},
    )
    assert islands.united({0: [(1, 3)]}, {0: [(3, 5), (0, 1)], 1: [(4, 4)]}) == {0: [(0, 5)], 1: [(4, 4)]}


def write_part(spark, path, offsets):
    rows = spark.createDataFrame([(None, str(o).encode(), "t", 0, o, None, 0, 0) for o in offsets], LOG_SCHEMA)
    rows.coalesce(1).write.mode("append").partitionBy("topic", "partition", "segment").parquet(path)


@pytest.mark.parametrize("parts", [(range(0, 100, 2), range(1, 100, 2)), (range(50, 100), range(0, 25), range(25, 50))])
def test_interleaved_files_end_with_the_true_offset(spark, tmp_path, parts):
    path = f"{tmp_path}/log"
    for part in parts:
        write_part(spark, path, part)
    steps = []

    def write(rows, batch):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch}")
        steps.append(read_state(spark, f"{tmp_path}/state"))

    ingest = TrackedIngest(TopicTable(spark, path), "t", shape(), write, f"{tmp_path}/state", StreamStart("beginning"), max_files=1)
    ingest.start_stream(f"{tmp_path}/check", ONCE).awaitTermination()
    assert len(steps) == len(parts)
    assert [s.ahead for s in steps if s and s.offsets[0] < 100 and s.ahead]
    state = read_state(spark, f"{tmp_path}/state")
    assert state.offsets == {0: 100} and state.ahead == {}
    assert sorted(r.o for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(100))


def test_a_replay_under_a_new_checkpoint_adds_no_row_twice(spark, tmp_path):
    path, out = f"{tmp_path}/log", f"{tmp_path}/out"
    for part in (range(0, 40, 2), range(1, 40, 2), range(40, 60)):
        write_part(spark, path, part)
    calls = []

    def write(rows, batch):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("failed after writing")

    def written():
        return spark.read.parquet(out) if calls else None

    def ingest():
        return TrackedIngest(TopicTable(spark, path), "t", shape(), write, f"{tmp_path}/state", StreamStart("beginning"), max_files=1, written=written)

    with pytest.raises(Exception, match="failed after writing"):
        ingest().start_stream(f"{tmp_path}/check", ONCE).awaitTermination()
    ingest().start_stream(f"{tmp_path}/other", ONCE).awaitTermination()
    assert sorted(r.o for r in spark.read.parquet(out).collect()) == list(range(60))
    state = read_state(spark, f"{tmp_path}/state")
    assert state.offsets == {0: 60} and state.ahead == {}


def test_of_two_savers_one_fails(spark, tmp_path):
    path = f"{tmp_path}/state"
    save_offsets(spark, path, {0: 1})
    one, other = read_state(spark, path), read_state(spark, path)
    save_state(spark, path, one, {0: 5})
    with pytest.raises(StateConflict, match="version 1"):
        save_state(spark, path, other, {0: 3, 1: 9})
    assert read_offsets(spark, path) == {0: 5}
    save_offsets(spark, path, {1: 9})
    for k in range(10):
        save_offsets(spark, path, {2: k})
    assert read_offsets(spark, path) == {0: 5, 1: 9, 2: 9}
    numbers = sorted(int(p.name) for p in (tmp_path / "state.versions").iterdir() if p.name.isdigit())
    assert numbers == list(range(numbers[-1] - 4, numbers[-1] + 1))
    # A file that a saver could not finish does not count, and its number is not used again.
    (tmp_path / "state.versions" / f"{numbers[-1] + 1:012d}").write_text('{"partitionOff')
    assert read_offsets(spark, path) == {0: 5, 1: 9, 2: 9}
    save_offsets(spark, path, {0: 6})
    assert read_state(spark, path).version == numbers[-1] + 2


def test_a_plain_file_is_the_state_before_the_first_save(spark, tmp_path):
    (tmp_path / "state").write_text('{"partitionOffsets":{"0":4}}')
    state = save_state(spark, f"{tmp_path}/state", read_state(spark, f"{tmp_path}/state"), {1: 2}, {0: [(6, 8)]}, 7)
    assert read_state(spark, f"{tmp_path}/state") == state
    assert (state.offsets, state.ahead, state.first_batch, state.version) == ({0: 4, 1: 2}, {0: [(6, 8)]}, 7, 1)


def test_rate_of_a_table_stream(spark, tmp_path):
    log = open_topic(spark, f"{tmp_path}/log")
    for low in range(0, 200, 20):
        send(log, low, low + 20, 2)
    assert log.rate_options(None, 1, 2, "t") == {} == log.rate_options(0, 1, 2, "t")
    with pytest.raises(ValueError):
        log.rate_options(-1, 1, 2)
    batches = []
    ingest = TrackedIngest(log, "t", shape(), lambda rows, batch: batches.append(rows.count()), f"{tmp_path}/state", StreamStart("beginning"), rate=20, interval_seconds=1.0)
    ingest.start_stream(f"{tmp_path}/check", ONCE).awaitTermination()
    # 20 messages a second of each of 2 partitions: 40 of 200 a batch.
    assert len(batches) >= 5 and sum(batches) == 200 and max(batches) <= 40
    assert read_offsets(spark, f"{tmp_path}/state") == {0: 100, 1: 100}


def test_packed_runs_are_the_runs(spark, monkeypatch):
    monkeypatch.setattr(islands, "PIECE_BITS", 15)
    monkeypatch.setattr(islands, "_PIECE", 1 << 15)
    pick, size = random.Random(7), 1 << 15
    spans = {0: [(0, 4), (size - 3, 2 * size + 5), (2 * size + 9, 2 * size + 10)], 1: [(3 * size, 4 * size)], 4: [(7, 9)]}
    more = {0: [(4, size - 3)], 2: [(o, o + 1) for o in sorted(pick.sample(range(0, 3 * size, 2), 2000))], 4: [(8, 12)]}
    packed, other = islands.PackedIntervals.of(spans), islands.PackedIntervals.of(more)
    assert packed == spans and dict(other) == {**more} and packed != more and islands.PackedIntervals.of({}) == {}
    both = packed.united(other)
    assert both == islands.united(spans, more)
    assert islands.PackedIntervals.parsed(both.content()) == both == islands.PackedIntervals.parsed({str(p): [list(x) for x in own] for p, own in both.items()})
    for at in ({}, {0: size}, {0: 2 * size + 5, 1: 3 * size + 1, 2: 1, 3: 8}, {4: 10}, {1: 5 * size, 9: 0}):
        moved, left = both.advanced(at)
        assert (moved, left) == islands.advanced(at, dict(both))
        some, rest = both.advanced(at, [0, 9])
        assert some == at | ({0: moved[0]} if 0 in moved else {}) and rest == {p: own for p, own in (dict(both) | {0: left.get(0)}).items() if own}
    offsets = [(p, o) for p, own in more.items() for a, b in own for o in range(a, b)]
    rows = spark.createDataFrame(offsets + offsets[:50], "partition int, offset bigint").repartition(3)
    assert islands.collect_packed(rows) == more == islands.collect_islands(rows)


def test_a_state_of_every_other_offset_stays_small(spark, tmp_path):
    half = spark.range(0, 1 << 19).selectExpr("cast(0 as int) as partition", "2 * id + 1 as offset")
    state = save_state(spark, f"{tmp_path}/state", None, {0: 0}, islands.collect_packed(half))
    (written,) = (f for f in (tmp_path / "state.versions").iterdir() if f.name.isdigit())
    # As numbers the runs took 8 MB, and every batch wrote them anew.
    assert written.stat().st_size < 10_000
    assert read_state(spark, f"{tmp_path}/state") == state
    assert state.ahead[0][:2] == [(1, 2), (3, 4)] and len(state.ahead[0]) == 1 << 19
