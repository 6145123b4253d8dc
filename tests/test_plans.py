"""The physical plans are the ones wanted at scale."""

import re

import pytest
from pyspark.sql import functions as F

from topicwright import (
    BatchIngest,
    OffsetRange,
    RecordShape,
    TopicTable,
    decode_topic,
    offset_bounds,
    open_topic,
    publish,
    to_messages,
)
from topicwright.operators.publish import with_offsets
from topicwright.operators.ranges import from_known_segments


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    log = open_topic(spark, f"{tmp_path_factory.mktemp('plans')}/log")
    rows = spark.range(1000).select("id", (F.col("id") % 9).cast("string").alias("k"))
    publish(to_messages(rows, "t", key="k", columns=["id", "k"], arrival="id"), log, 4)
    return log


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_range_read_reaches_folders_and_row_groups(log):
    text = plan(log.read([OffsetRange("t", 1, 5, 9), OffsetRange("t", 2, 6, 9)]))
    scan = text[text.index("FileScan"):]
    folders, pushed = scan.split("PartitionFilters: ")[1].split("PushedFilters: ")
    for column in ("topic", "partition", "segment"):
        assert column in folders
    assert "GreaterThanOrEqual(offset," in pushed and "LessThan(offset," in pushed
    assert "Exchange" not in text and "Join" not in text


def test_decode_reads_only_the_payload(log):
    shape = RecordShape("id bigint, k string", format="csv")
    text = plan(decode_topic(log.rows(), shape).select("k"))
    assert re.search(r"ReadSchema: struct<value:binary>", text)
    assert "Exchange" not in text and "Python" not in text


def test_batch_ingest_is_one_narrow_stage(log):
    text = plan(BatchIngest(log, "t", RecordShape("body binary")).rows())
    assert "Exchange" not in text and "*(1) Project" in text


def test_numbering_shuffles_the_payload_once(spark, log):
    rows = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    messages = to_messages(rows, "orders", key="o_orderpriority", columns=rows.columns, arrival="o_orderkey")
    frame = with_offsets(messages, 4)
    frame.collect()
    lines = plan(frame).split("Initial Plan")[0].split("\n")
    payload_exchanges = [
        i for i, line in enumerate(lines)
        if "Exchange hashpartitioning" in line and any("value#" in later for later in lines[i + 1:i + 3])
    ]
    assert len(payload_exchanges) == 1
    assert not any("CartesianProduct" in line or "NestedLoop" in line for line in lines)


def test_bounds_come_from_footers(spark, log):
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = TopicTable(session, log.path).rows()
    for some in (rows, rows.filter(from_known_segments({("t", 1): 5, ("t", 2): 1 << 20}))):
        text = plan(offset_bounds(some))
        assert "PushedAggregation: [MIN(offset), MAX(offset), COUNT(*)]" in text
        assert "PushedGroupBy: [topic, partition, segment]" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
