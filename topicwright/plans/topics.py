"""Topics derived from the given tables, for the queries and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwright.functions.shape import RecordShape
from topicwright.operators.publish import publish, to_messages
from topicwright.sources.topic_log import TopicTable

EVENT_PARTITIONS = 4
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]
EVENT_FIELDS = "event_id bigint, user_id bigint, event_type string, value double"
EVENT_SCHEMA = (
    T.StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string").add("value", "double")
)
EVENT_SHAPE = RecordShape(EVENT_SCHEMA, format="csv")
PLACED_EVENT_SHAPE = RecordShape(
    T.StructType([*T.StructType().add("partition", "integer").add("offset", "long"), *EVENT_SCHEMA]),
    format="csv",
    partition_field="partition",
    offset_field="offset",
)

_published: dict[tuple, TopicTable] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder of the session, which all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        root = tempfile.mkdtemp(prefix="topicwright-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/topicwright/{name}-{uuid.uuid4().hex}"


def published(
    spark: SparkSession, sf_dir: str, name: str, messages: Callable[[], DataFrame], partitions: int
) -> TopicTable:
    """The topic table of these messages, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _published:
        log = TopicTable(spark, scratch(spark, name))
        publish(messages(), log, partitions)
        _published[key] = log
    return TopicTable(spark, _published[key].path)


def event_messages(events: DataFrame, topic="events", body: str = "csv") -> DataFrame:
    """Events keyed by user, in order of their id."""
    rows = events.withColumn("key", F.col("user_id").cast("string"))
    stamp = F.col("ts").cast("timestamp")
    return to_messages(rows, topic, body, "key", EVENT_COLUMNS, arrival="event_id", timestamp=stamp)


def event_topic(spark: SparkSession, sf_dir: str) -> TopicTable:
    def messages():
        return event_messages(table(spark, sf_dir, "events"))

    return published(spark, sf_dir, "events", messages, EVENT_PARTITIONS)


WIDE_PARTITIONS = 400


def wide_topic(spark: SparkSession, sf_dir: str) -> TopicTable:
    """Events keyed by their id over several hundred partitions, in two appends."""
    key = (spark.sparkContext.applicationId, sf_dir, "wide")
    if key not in _published:
        log = TopicTable(spark, scratch(spark, "wide"))
        events = table(spark, sf_dir, "events").withColumn("key", F.col("event_id").cast("string"))
        early = F.col("event_type") == "click"
        for part in (events.filter(early), events.filter(~early)):
            log.append(to_messages(part, "wide", key="key", columns=EVENT_COLUMNS, arrival="event_id"), WIDE_PARTITIONS)
        _published[key] = log
    return TopicTable(spark, _published[key].path)


def event_type_topics(spark: SparkSession, sf_dir: str) -> TopicTable:
    """One topic per event type, in one table."""

    def messages():
        return event_messages(table(spark, sf_dir, "events"), topic=F.col("event_type"))

    return published(spark, sf_dir, "event_types", messages, 2)


def document_topic(spark: SparkSession, sf_dir: str) -> TopicTable:
    """Whole texts, keyed by document."""

    def messages():
        rows = table(spark, sf_dir, "documents").withColumn("key", F.col("doc_id").cast("string"))
        return to_messages(rows, "documents", key="key", columns=["text"], arrival="doc_id")

    return published(spark, sf_dir, "documents", messages, EVENT_PARTITIONS)


def lines(rows: DataFrame, line) -> DataFrame:
    """Messages without a key whose value is a text line."""
    return rows.select(F.lit(None).cast("binary").alias("key"), line.cast("binary").alias("value"))


def web_log_lines(pages: DataFrame) -> DataFrame:
    """A Common Log Format line for each page."""
    return lines(
        pages,
        F.concat(
            F.regexp_extract("url", "^https?://([^/?#]+)", 1),
            F.lit(" - user"),
            F.col("page_id").cast("string"),
            F.lit(' [10/Oct/2000:13:55:36 +0000] "GET '),
            F.regexp_extract("url", "^https?://[^/?#]+(.*)$", 1),
            F.lit(' HTTP/1.1" 200 '),
            F.length("html").cast("string"),
        ),
    )


def syslog_lines(events: DataFrame) -> DataFrame:
    """A syslog line for each event."""
    return lines(
        events,
        F.concat(
            F.lit("<"),
            F.pmod("event_id", F.lit(192)).cast("string"),
            F.lit(">"),
            F.date_format("ts", "MMM dd HH:mm:ss"),
            F.lit(" host"),
            F.col("user_id").cast("string"),
            F.lit(" "),
            F.col("event_type"),
            F.lit("["),
            F.col("event_id").cast("string"),
            F.lit("]: "),
            F.col("props"),
        ),
    )
