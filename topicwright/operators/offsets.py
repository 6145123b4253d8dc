"""Offset algebra: relations of one row per topic partition.

An offset map is a DataFrame ``(topic, partition, offset)``. None of these relations
grows with the messages, only with the number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The offsets that stand for the first and the next message of a partition.
EARLIEST = -2
LATEST = -1

_PARTITION = ["topic", "partition"]
_PARTITION_SCHEMA = [("topic", pa.string()), ("partition", pa.int32())]


class OffsetError(ValueError):
    """Offsets that cannot be read from."""


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: pa.Schema) -> DataFrame:
    """Rows held by the driver (a plan, never messages) as a local relation of known size."""
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.table(columns, schema=schema))


def offset_table(spark: SparkSession, topic: str, offsets: Mapping[int, int]) -> DataFrame:
    """Offset map from a partition-to-offset mapping."""
    return offsets_of(spark, {(topic, p): o for p, o in offsets.items()})


def offsets_of(spark: SparkSession, offsets: Mapping[tuple[str, int], int]) -> DataFrame:
    """Offset map from a (topic, partition)-to-offset mapping."""
    schema = pa.schema([*_PARTITION_SCHEMA, ("offset", pa.int64())])
    return local_table(spark, [(*place, o) for place, o in offsets.items()], schema)


def collect_offsets(offsets: DataFrame) -> dict[int, int]:
    """One topic's offset map on the driver: one entry per partition."""
    return {row.partition: row.offset for row in offsets.select("partition", "offset").collect()}


def bounds_table(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Collected offset bounds as a relation again."""
    numbers = [(name, pa.int64()) for name in ("earliest", "latest", "messages")]
    return local_table(spark, rows, pa.schema([*_PARTITION_SCHEMA, *numbers]))


def offset_bounds(log: DataFrame) -> DataFrame:
    """Earliest offset, next offset to be written and number of messages of each partition."""
    # Per segment first where there are any: a scan only takes over an aggregate that is
    # grouped by all of its partition columns.
    segment = ["segment"] if "segment" in log.columns else []
    parts = log.groupBy(*_PARTITION, *segment).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n")
    )
    return parts.groupBy(*_PARTITION).agg(
        F.min("first").alias("earliest"),
        (F.max("last") + 1).alias("latest"),
        F.sum("n").alias("messages"),
    )


def earliest_offsets(bounds: DataFrame) -> DataFrame:
    return bounds.select(*_PARTITION, F.col("earliest").alias("offset"))


def latest_offsets(bounds: DataFrame) -> DataFrame:
    return bounds.select(*_PARTITION, F.col("latest").alias("offset"))


def select_partitions(rows: DataFrame, partitions: Iterable[int] | None) -> DataFrame:
    """Keep the listed partitions; none listed keeps all, and unknown ids are ignored."""
    wanted = sorted(set(partitions or ()))
    return rows.filter(F.col("partition").isin(wanted)) if wanted else rows


def start_policy(bounds: DataFrame, policy: str | None = None, specific: int | None = None) -> DataFrame:
    """Starting offset of every partition: ``beginning``, ``latest`` (default) or ``specific``."""
    if policy == "specific" and specific is None:
        raise OffsetError("The specific start policy needs an offset.")
    starts = {"beginning": EARLIEST, "latest": LATEST}
    if policy not in (None, "specific", *starts):
        raise OffsetError(f"Unknown start policy '{policy}'.")
    fallback = LATEST if specific is None else specific
    offset = F.lit(starts.get(policy, fallback)).cast("bigint")
    return bounds.select(*_PARTITION, offset.alias("offset"))


def apply_overrides(starts: DataFrame, overrides: DataFrame) -> DataFrame:
    """Explicit offsets replace the default ones; overrides of other partitions are ignored."""
    given = overrides.withColumnRenamed("offset", "given")
    return starts.join(given, _PARTITION, "left").select(
        *_PARTITION, F.coalesce("given", "offset").alias("offset")
    )


def resolve_sentinels(starts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Put the real earliest and latest offsets for ``EARLIEST`` and ``LATEST``; missing ones fail."""
    missing = F.raise_error(
        F.concat(
            F.lit("No offsets known for topic "),
            "topic",
            F.lit(", partition "),
            F.col("partition").cast("string"),
        )
    ).cast("bigint")
    real = (
        F.when(F.col("offset") == EARLIEST, F.coalesce("earliest", missing))
        .when(F.col("offset") == LATEST, F.coalesce("latest", missing))
        .otherwise(F.col("offset"))
    )
    return starts.join(bounds, _PARTITION, "left").select(*_PARTITION, real.alias("offset"))


def batch_start(bounds: DataFrame, configured: DataFrame, saved: DataFrame) -> DataFrame:
    """Saved, else configured, else earliest offset. A negative start fails."""
    joined = bounds.join(saved.withColumnRenamed("offset", "saved"), _PARTITION, "left").join(
        configured.withColumnRenamed("offset", "configured"), _PARTITION, "left"
    )
    start = F.coalesce("saved", "configured", "earliest")
    failure = F.raise_error(
        F.concat(
            F.lit("No valid start offset for topic "),
            "topic",
            F.lit(", partition "),
            F.col("partition").cast("string"),
        )
    ).cast("bigint")
    return joined.select(*_PARTITION, F.when(start >= 0, start).otherwise(failure).alias("offset"))


def resume_offsets(starts: DataFrame, saved: DataFrame, bounds: DataFrame) -> DataFrame:
    """A non-empty saved map replaces all configured starts.

    Partitions it does not hold are newer than the save and start at their earliest offset.
    """
    any_saved = saved.agg(F.count("*")).scalar() > 0
    joined = starts.join(saved.withColumnRenamed("offset", "saved"), _PARTITION, "left").join(
        earliest_offsets(bounds).withColumnRenamed("offset", "first"), _PARTITION, "left"
    )
    offset = F.when(any_saved, F.coalesce("saved", "first")).otherwise(F.col("offset"))
    return joined.select(*_PARTITION, offset.alias("offset"))


def saved_offset_problems(saved: DataFrame, bounds: DataFrame) -> DataFrame:
    """Saved offsets outside their partition's range, or of no known partition, with a message."""
    joined = saved.join(bounds, _PARTITION, "left")
    outside = (
        F.col("earliest").isNull()
        | (F.col("offset") < F.col("earliest"))
        | (F.col("offset") > F.col("latest"))
    )
    place = "Offset %d, saved for topic %s, partition %d, "
    message = F.when(
        F.col("earliest").isNull(),
        F.format_string(place + "belongs to no known partition.", "offset", "topic", "partition"),
    ).otherwise(
        F.format_string(
            place + "is outside its range %d to %d.",
            "offset", "topic", "partition", "earliest", "latest",
        )
    )
    return joined.filter(outside).select(
        *_PARTITION, "offset", "earliest", "latest", message.alias("message")
    )


def check_saved(saved: DataFrame, bounds: DataFrame) -> None:
    """Fail with one message that lists every saved offset that cannot be resumed from."""
    problems = saved_offset_problems(saved, bounds).orderBy(*_PARTITION).select("message").collect()
    if problems:
        raise OffsetError("Cannot resume from the saved offsets:\n" + "\n".join(row.message for row in problems))
