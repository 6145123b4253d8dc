"""Looking into a topic store: which topics there are, and their first messages."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwright.functions.payload import payload_text
from topicwright.operators.offsets import earliest_offsets, local_table
from topicwright.operators.ranges import collect_ranges, plan_ranges


def topic_of_path(path: str) -> str:
    """The topic a path names, empty for the root."""
    topic = re.sub(r"^/+|/+$", "", path)
    if "/" in topic:
        raise ValueError(f"Path {path} must be the root or name a single topic")
    return topic


def sample_topic(topic, path: str, limit: int) -> DataFrame:
    """The first ``limit`` messages as text, lowest partition first.

    No partition can contribute more than ``limit`` messages, so only those are read.
    """
    name = topic_of_path(path)
    if not name:
        raise ValueError("The path names no topic")
    limit = max(limit, 0)
    bounds = topic.bounds(name)
    ranges = collect_ranges(plan_ranges(earliest_offsets(bounds), bounds, limit)) if limit else []
    return (
        topic.read(ranges)
        .orderBy("partition", "offset")
        .limit(limit)
        .select(payload_text(F.col("value")).alias("message"))
    )


def list_topics(topic, path: str = "/", limit: int | None = None) -> DataFrame:
    """Topics by name with the total before the limit; a path gives that topic or nothing.

    Internal topics (names starting with two underscores) are hidden. No limit, or one
    below 1, lists all.
    """
    name = topic_of_path(path)
    names = [t for t in topic.topics() if not t.startswith("__") and name in ("", t)]
    listed = names[:limit] if limit and limit > 0 else names
    schema = pa.schema([("topic", pa.string()), ("total", pa.int64())])
    return local_table(topic.spark, [(t, len(names)) for t in listed], schema)
