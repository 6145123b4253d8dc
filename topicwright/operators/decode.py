"""Typed rows from topic messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.functions import payload
from topicwright.functions.shape import RecordShape


def decode_topic(
    log: DataFrame, shape: RecordShape, batch_time: Column | None = None, keep_nulls: bool | None = None
) -> DataFrame:
    """Messages as rows of the declared schema, in declared order and type.

    A batch turns null keys and values into empty bytes; a stream keeps them, and so does a
    micro-batch of one with ``keep_nulls``. The time
    column is one value for a whole (micro-)batch, in milliseconds.
    """
    if shape.time_field and not log.isStreaming and batch_time is None:
        raise ValueError("A time field needs a stream or a batch time.")
    key, value = F.col("key"), F.col("value")
    if not (log.isStreaming if keep_nulls is None else keep_nulls):
        empty = F.lit(b"")
        key, value = F.coalesce(key, empty), F.coalesce(value, empty)
    time = batch_time if batch_time is not None else F.unix_millis(F.current_timestamp())
    metadata = {"time": time, "key": key, "partition": F.col("partition"), "offset": F.col("offset")}

    kinds = shape.metadata_fields
    decoded = iter(_message_columns(value, shape))
    columns = []
    for field in shape.schema.fields:
        if field.name in kinds:
            columns.append(metadata[kinds[field.name]].cast(field.dataType).alias(field.name))
        else:
            columns.append(next(decoded))
    return log.select(*columns)


def _message_columns(value: Column, shape: RecordShape) -> list[Column]:
    fields = shape.message_fields
    names = [f.name for f in fields]
    match shape.format:
        case None | "binary":
            return [value.alias(names[0])]
        case "text":
            return [payload.payload_text(value).alias(names[0])]
        case "csv":
            return payload.delimited_fields(value, fields, ",")
        case "tsv":
            return payload.delimited_fields(value, fields, "\t")
        case "clf":
            known, pattern = payload.CLF_FIELDS, payload.CLF_PATTERN
        case "syslog":
            known, pattern = payload.SYSLOG_FIELDS, payload.SYSLOG_PATTERN
        case _:
            known, pattern = names, shape.pattern
            if grok := shape.grok:
                known, pattern = [name for name, _ in grok.fields], grok.pattern
    groups = [known.index(name) + 1 for name in names]
    return payload.pattern_fields(value, fields, pattern, groups, len(known))
