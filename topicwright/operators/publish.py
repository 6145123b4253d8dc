"""Rows and alerts to topic messages, and appending them to a topic."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwright.functions.partitioner import key_digest, partition_of_digest, round_robin_partition
from topicwright.functions.payload import csv_body, json_body
from topicwright.operators.numbering import BLOCK_BYTES, number_rows
from topicwright.operators.ranges import segment_of

logger = logging.getLogger(__name__)

# Assumed bytes of a message beside its key and body.
MESSAGE_OVERHEAD = 32


def to_messages(
    rows: DataFrame,
    topic: str | Column,
    body: str = "csv",
    key: str | None = None,
    columns: list[str] | None = None,
    arrival: str | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows as messages ``(topic, key, value, timestamp[, arrival])``.

    ``body`` is ``json``, or CSV for any other name. A ``key`` field gives keyed messages;
    a null in it fails the run. ``arrival`` names a unique integer column that gives the
    order of the messages. The body holds all columns unless ``columns`` names some.
    """
    columns = columns or rows.columns
    text = json_body(columns) if body.lower() == "json" else csv_body(columns)
    if key is None:
        key_bytes = F.lit(None).cast("binary")
    else:
        if not isinstance(rows.schema[key].dataType, T.StringType):
            raise ValueError(f"The key field '{key}' must be of type string.")
        failure = F.raise_error(F.lit(f"Null in the key field {key}"))
        key_bytes = F.coalesce(F.col(key), failure.cast("string")).cast("binary")
    out = [
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        key_bytes.alias("key"),
        text.cast("binary").alias("value"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
    ]
    if arrival is not None:
        missing = F.raise_error(F.lit(f"Null in the arrival column {arrival}"))
        out.append(F.coalesce(F.col(arrival), missing.cast("bigint")).cast("bigint").alias("arrival"))
    return rows.select(*out)


def with_partition(messages: DataFrame, partitions: int) -> DataFrame:
    """Add the target partition: hash of the key, or round robin by arrival without a key."""
    # The digest is a column of its own, so that it is computed only once.
    digested = messages.select("*", key_digest(F.col("key").cast("string")).alias("_digest"))
    keyed = partition_of_digest(F.col("_digest"), partitions)
    spread = round_robin_partition(F.col("arrival"), partitions)
    # The last value makes the column not nullable, which spares filters that repeat the hash.
    return digested.select(*messages.columns, F.coalesce(keyed, spread, F.lit(0)).alias("partition"))


def with_arrival(messages: DataFrame) -> DataFrame:
    """Give messages without one an arrival number, fixed by a checkpoint.

    The number depends on how the input was split, and it is read more than once, so it
    must not be computed again.
    """
    if "arrival" in messages.columns:
        return messages
    spark = messages.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        raise ValueError("Set spark.checkpoint.dir, or give the messages an arrival column.")
    return messages.withColumn("arrival", F.monotonically_increasing_id()).checkpoint()


def with_offsets(
    messages: DataFrame,
    partitions: int,
    latest: Mapping[tuple[str, int], int] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Topic rows: each message with its partition and the next free offset there.

    ``latest`` is the next offset of each (topic, partition). Messages of ``block_bytes`` at most are numbered in one task.
    """
    placed = with_partition(with_arrival(messages), partitions)
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("key", "value")), F.lit(MESSAGE_OVERHEAD))
    numbered = number_rows(placed, ["topic", "partition"], "arrival", "offset", latest, size, block_bytes)
    return numbered.select(
        "key", "value", "topic", "partition", "offset", "timestamp", F.lit(0).alias("timestampType")
    )


def segmented(rows: DataFrame) -> DataFrame:
    """Topic rows laid out for writing. They come in blocks of one partition, so a segment has as many files as its bytes need."""
    rows = rows.withColumn("segment", segment_of(F.col("offset")))
    return rows.sortWithinPartitions("topic", "partition", "segment", "offset")


def publish(messages: DataFrame, topic, partitions: int | None = None) -> None:
    """Append messages to a topic (a table or a live topic), at least once."""
    topic.append(messages, partitions)


def split_on_null(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a value in all watched columns, and rows with a null in any of them."""
    any_null = _any_null(columns)
    return rows.filter(~any_null), rows.filter(any_null)


def route_on_null(
    rows: DataFrame,
    columns: list[str],
    topic: str,
    alert_topic: str,
    stage: str,
    body: str = "csv",
    key: str | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """Messages of a whole frame in one pass: a row with a null in a watched column becomes an
    alert for ``alert_topic`` without a key, any other row a message for ``topic``, keyed by ``key``
    if given, in which a null fails the run."""
    any_null = _any_null(columns)
    alert = F.struct(F.lit(stage).alias("stageName"), _payload([]).alias("payload"))
    text = json_body(rows.columns) if body.lower() == "json" else csv_body(rows.columns)
    keyed = F.lit(None).cast("binary")
    if key is not None:
        failure = F.raise_error(F.lit(f"Null in the key field {key}")).cast("string")
        keyed = F.when(~any_null, F.coalesce(F.col(key), failure)).cast("binary")
    order = [] if arrival is None else [F.col(arrival).cast("bigint").alias("arrival")]
    return rows.select(
        F.when(any_null, F.lit(alert_topic)).otherwise(F.lit(topic)).alias("topic"),
        keyed.alias("key"),
        F.when(any_null, F.to_json(alert)).otherwise(text).cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
        *order,
    )


def _any_null(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def _payload(columns: list[str]) -> Column:
    entries = [F.struct(F.lit(c), F.col(c).cast("string")) for c in columns]
    pairs = F.array(*entries) if entries else F.array().cast("array<struct<key:string,value:string>>")
    return F.map_from_entries(pairs)


def alerts(rows: DataFrame, stage: str, payload: list[str] | None = None) -> DataFrame:
    """One alert ``(stageName, payload)`` per row, with the named columns as its payload."""
    return rows.select(F.lit(stage).alias("stageName"), _payload(payload or []).alias("payload"))


def alert_messages(alert_rows: DataFrame, topic: str) -> DataFrame:
    """Alerts as JSON messages without a key."""
    return to_messages(alert_rows, topic, body="json", columns=["stageName", "payload"])


def publish_alerts(alert_rows: DataFrame, name: str, topic, partitions: int | None = None) -> bool:
    """Publish alerts on their own; a failure is logged and does not stop the caller."""
    try:
        publish(alert_messages(alert_rows, name), topic, partitions)
        return True
    except Exception:
        logger.exception("Could not publish alerts to topic %s", name)
        return False
