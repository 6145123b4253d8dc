"""Offset audit: which offsets of a partition are missing, and which are there more than once."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwright.operators.islands import offset_islands
from topicwright.operators.offsets import local_table
from topicwright.operators.ranges import segment_of

MISSING = "missing"
REPEATED = "repeated"

_SCHEMA = pa.schema(
    [("topic", pa.string()), ("partition", pa.int32()), ("kind", pa.string()), ("start_offset", pa.int64()), ("end_offset", pa.int64())]
)


def audit_offsets(log, topic: str | None = None, thorough: bool = False) -> DataFrame:
    """Each run of missing or repeated offsets of a topic table, ``(topic, partition, kind, start_offset, end_offset)``.

    Offsets before the earliest one are not missing: they were removed on purpose. Whole segments that are missing are known
    from the segment index, or from file footers. Rows are only read in segments whose number of messages
    differs from their span of offsets, one segment at a time. A segment that misses as many messages as
    it repeats is only found by a ``thorough`` audit, which reads the offsets of all segments.
    """
    segments = log.segments(topic)
    gaps, suspicious, before = [], [], None
    for s in segments:
        if before is not None and before[:2] == s[:2] and before.last + 1 < s.first:
            gaps.append((s.topic, s.partition, MISSING, before.last + 1, s.first))
        if thorough or s.messages != s.last - s.first + 1:
            suspicious.append(s)
        before = s
    found = local_table(log.spark, gaps, _SCHEMA)
    return found.unionByName(_runs(log.segment_rows([s[:3] for s in suspicious]))) if suspicious else found


def _runs(rows: DataFrame) -> DataFrame:
    place = ["topic", "partition", "segment"]
    counted = rows.select("topic", "partition", segment_of(F.col("offset")).alias("segment"), "offset")
    counted = counted.groupBy(*place, "offset").agg(F.count("*").alias("times"))
    repeated = offset_islands(counted.filter("times > 1")).withColumn("kind", F.lit(REPEATED))
    # Missing offsets lie between the end of one island of a segment and the start of the next.
    end_before = F.lag("end_offset").over(Window.partitionBy(*place).orderBy("start_offset")).alias("end_before")
    between = offset_islands(counted, place).select("topic", "partition", end_before, "start_offset").filter("end_before is not null")
    missing = between.select(
        "topic", "partition", F.lit(MISSING).alias("kind"), F.col("end_before").alias("start_offset"), F.col("start_offset").alias("end_offset")
    )
    return repeated.select(*_SCHEMA.names).unionByName(missing)
