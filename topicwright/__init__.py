"""Topic ingest and publish on Spark.

A *topic* is a partitioned, append-only sequence of ``(key, value)`` messages.
This package plans which offsets to read, reads them as DataFrames, decodes the
payloads, remembers where it stopped, and publishes rows and alerts back.
"""

from topicwright.functions.grok import compile_grok
from topicwright.functions.partitioner import round_robin_partition, string_partition
from topicwright.functions.payload import csv_body, json_body, payload_text
from topicwright.functions.shape import RecordShape, ShapeError
from topicwright.operators.audit import audit_offsets
from topicwright.operators.decode import decode_topic
from topicwright.operators.islands import offset_islands
from topicwright.operators.offsets import (
    LATEST,
    EARLIEST,
    OffsetError,
    apply_overrides,
    batch_start,
    check_saved,
    earliest_offsets,
    latest_offsets,
    offset_bounds,
    offset_table,
    resolve_sentinels,
    resume_offsets,
    saved_offset_problems,
    select_partitions,
    start_policy,
)
from topicwright.operators.publish import (
    alert_messages,
    alerts,
    publish,
    publish_alerts,
    route_on_null,
    split_on_null,
    to_messages,
)
from topicwright.operators.ranges import (
    OffsetRange,
    backlog,
    collect_ranges,
    plan_ranges,
    read_ranges,
)
from topicwright.operators.state import (
    StateConflict,
    load_offsets,
    offsets_file,
    read_offsets,
    read_state,
    save_offsets,
    save_state,
)
from topicwright.plans.ingest import BatchIngest
from topicwright.sources.catalog import list_topics, sample_topic
from topicwright.sources.topic_log import KafkaTopic, TopicTable, open_topic
from topicwright.streaming.ingest import StreamStart, TrackedIngest, start_ingest, stream_publish

__all__ = [
    "BatchIngest",
    "EARLIEST",
    "KafkaTopic",
    "LATEST",
    "OffsetError",
    "OffsetRange",
    "RecordShape",
    "ShapeError",
    "StateConflict",
    "StreamStart",
    "TopicTable",
    "TrackedIngest",
    "alert_messages",
    "alerts",
    "apply_overrides",
    "audit_offsets",
    "backlog",
    "batch_start",
    "check_saved",
    "collect_ranges",
    "compile_grok",
    "csv_body",
    "decode_topic",
    "earliest_offsets",
    "json_body",
    "latest_offsets",
    "list_topics",
    "load_offsets",
    "read_offsets",
    "offset_bounds",
    "offset_islands",
    "offset_table",
    "offsets_file",
    "open_topic",
    "payload_text",
    "plan_ranges",
    "publish",
    "publish_alerts",
    "read_ranges",
    "read_state",
    "resolve_sentinels",
    "resume_offsets",
    "round_robin_partition",
    "route_on_null",
    "sample_topic",
    "save_offsets",
    "save_state",
    "saved_offset_problems",
    "select_partitions",
    "split_on_null",
    "start_ingest",
    "start_policy",
    "stream_publish",
    "string_partition",
    "to_messages",
]
