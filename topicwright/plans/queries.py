"""One query per operator, each over whole tables or topics made from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.functions.partitioner import string_partition
from topicwright.functions.payload import payload_text
from topicwright.functions.shape import RecordShape
from topicwright.operators import offsets as off
from topicwright.operators.audit import audit_offsets
from topicwright.operators.decode import decode_topic
from topicwright.operators.islands import offset_islands
from topicwright.operators.publish import (
    alert_messages,
    alerts,
    publish,
    route_on_null,
    split_on_null,
    to_messages,
    with_partition,
)
from topicwright.operators.ranges import backlog, collect_ranges, plan_ranges
from topicwright.operators.state import load_offsets, offsets_file, save_offsets
from topicwright.plans import topics as tp
from topicwright.plans.ingest import BatchIngest
from topicwright.sources.catalog import list_topics, sample_topic
from topicwright.sources.topic_log import TopicTable
from topicwright.streaming.ingest import StreamStart, TrackedIngest, start_ingest, stream_publish

FROM_START = StreamStart("beginning")
ONCE = {"availableNow": True}


def _offset_map(spark: SparkSession, offsets: dict[int, int]) -> DataFrame:
    return off.offset_table(spark, "events", offsets)


def _text_rows(log: DataFrame) -> DataFrame:
    """Topic rows with key and value as text."""
    return log.select(
        "topic", "partition", "offset",
        payload_text(F.col("key")).alias("key"), payload_text(F.col("value")).alias("value"),
    )


def _fraction(bounds: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Offset map a fraction of the way through each partition."""
    part = F.floor(F.col("latest") * numerator / denominator).cast("bigint")
    return bounds.select("topic", "partition", part.alias("offset"))


# Sources


def bounded_scan(spark, sf_dir):
    return BatchIngest(tp.event_topic(spark, sf_dir), "events", tp.PLACED_EVENT_SHAPE).rows()


def stream_scan(spark, sf_dir):
    log = tp.event_topic(spark, sf_dir)
    output = tp.scratch(spark, "stream-scan")
    query = (
        _text_rows(log.stream())
        .writeStream.format("parquet")
        .option("path", f"{output}/rows")
        .option("checkpointLocation", f"{output}/checkpoint")
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{output}/rows")


def partition_select(spark, sf_dir):
    log = tp.event_topic(spark, sf_dir)
    return BatchIngest(log, "events", tp.PLACED_EVENT_SHAPE, partitions=[0, 2, 9]).rows()


def topic_sample(spark, sf_dir):
    return sample_topic(tp.event_topic(spark, sf_dir), "/events/", 100)


def topic_catalogue(spark, sf_dir):
    return list_topics(tp.event_type_topics(spark, sf_dir), "/", 3)


def topic_lookup(spark, sf_dir):
    return list_topics(tp.event_type_topics(spark, sf_dir), "/click/")


# Offsets


def earliest(spark, sf_dir):
    return off.earliest_offsets(tp.event_topic(spark, sf_dir).bounds())


def latest(spark, sf_dir):
    return off.latest_offsets(tp.event_topic(spark, sf_dir).bounds())


def start_policy(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    beginning, last, default, given = (
        off.start_policy(bounds, policy, specific).withColumn("policy", F.lit(policy or "default"))
        for policy, specific in [("beginning", None), ("latest", None), (None, None), ("specific", 7)]
    )
    return beginning.unionByName(last).unionByName(default).unionByName(given)


def start_override(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    return off.apply_overrides(off.start_policy(bounds, "beginning"), _offset_map(spark, {1: 5, 2: 7, 9: 1}))


def sentinel_substitution(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    starts = off.apply_overrides(off.start_policy(bounds, "beginning"), _offset_map(spark, {1: -1, 2: 7}))
    return off.resolve_sentinels(starts, bounds)


def batch_start(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    return off.batch_start(bounds, _offset_map(spark, {0: 3, 1: 4}), _offset_map(spark, {1: 9}))


def range_plan(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    starts = off.batch_start(bounds, _offset_map(spark, {0: 3}), _offset_map(spark, {1: 9}))
    return plan_ranges(starts, bounds, 100)


def range_read(spark, sf_dir):
    log = tp.event_topic(spark, sf_dir)
    bounds = log.bounds()
    ends = _fraction(bounds, 2, 3).withColumnRenamed("offset", "end_offset")
    starts = _fraction(bounds, 1, 3).withColumnRenamed("offset", "start_offset")
    ranges = collect_ranges(starts.join(ends, ["topic", "partition"]))
    return decode_topic(log.read(ranges), tp.PLACED_EVENT_SHAPE)


def many_ranges(spark, sf_dir):
    """The last offset of each of several hundred partitions, and all of the first partition."""
    log = tp.wide_topic(spark, sf_dir)
    bounds = log.bounds("wide")
    start = F.when(F.col("partition") == 0, F.col("earliest")).otherwise(F.col("latest") - 1)
    ranges = collect_ranges(bounds.select("topic", "partition", start.alias("start_offset"), F.col("latest").alias("end_offset")))
    return _text_rows(log.read(ranges))


def segment_index(spark, sf_dir):
    """What each segment of a topic of two appends holds."""
    columns = "topic string, partition int, segment bigint, first_offset bigint, last_offset bigint, messages bigint"
    segments = tp.wide_topic(spark, sf_dir).segments("wide")
    return spark.createDataFrame([(s.topic, s.partition, s.segment, s.first, s.last, s.messages) for s in segments], columns)


def _copied(spark, sf_dir, name, *parts):
    """The event topic written anew, one file a partition for each part that a condition takes."""
    rows = tp.event_topic(spark, sf_dir).rows("events")
    log = TopicTable(spark, tp.scratch(spark, name))
    for part in parts:
        laid = rows.filter(part).repartition("partition").sortWithinPartitions("topic", "partition", "segment", "offset")
        laid.write.mode("append").partitionBy("topic", "partition", "segment").parquet(log.path)
    return log


def offset_audit(spark, sf_dir):
    """Missing and repeated offsets of a damaged copy of the event topic."""
    kept = ~F.pmod("offset", F.lit(97)).between(5, 8)
    log = _copied(spark, sf_dir, "damaged", kept, kept & F.pmod("offset", F.lit(101)).isin(3, 4))
    return audit_offsets(log, "events")


def resume(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    starts = FROM_START.offsets(tp.event_topic(spark, sf_dir), "events", bounds)
    return off.resume_offsets(starts, _offset_map(spark, {0: 10, 2: 20}), bounds)


def saved_offset_check(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    saved = _offset_map(spark, {0: -5, 1: 3, 2: 1 << 60, 9: 1})
    return off.saved_offset_problems(saved, bounds)


def state_load(spark, sf_dir):
    path = offsets_file(tp.scratch(spark, "state"), "default", "load")
    latest = off.latest_offsets(tp.event_topic(spark, sf_dir).bounds())
    save_offsets(spark, path, off.collect_offsets(latest))
    return load_offsets(spark, path, "events")


def state_save(spark, sf_dir):
    folder = tp.scratch(spark, "state")
    log = tp.event_topic(spark, sf_dir)
    for _ in range(2):
        run = BatchIngest(log, "events", tp.EVENT_SHAPE, max_records=1000, offset_folder=folder)
        run.run(lambda rows: rows.write.format("noop").mode("overwrite").save())
    return load_offsets(spark, run.state_path, "events")


def backlog_estimate(spark, sf_dir):
    bounds = tp.event_topic(spark, sf_dir).bounds()
    starts = off.batch_start(bounds, _offset_map(spark, {}), _fraction(bounds, 1, 3))
    return backlog(plan_ranges(starts, bounds))


# Decoding


def raw_payload(spark, sf_dir):
    rows = BatchIngest(tp.event_topic(spark, sf_dir), "events", RecordShape("body binary")).rows()
    return rows.select(payload_text(F.col("body")).alias("body"))


def csv_decode(spark, sf_dir):
    return BatchIngest(tp.event_topic(spark, sf_dir), "events", tp.EVENT_SHAPE).rows()


def tsv_decode(spark, sf_dir):
    events = tp.table(spark, sf_dir, "events").select(*tp.EVENT_COLUMNS)
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in tp.EVENT_COLUMNS])
    return decode_topic(tp.lines(events, line), RecordShape(tp.EVENT_FIELDS, format="tsv"))


def text_decode(spark, sf_dir):
    shape = RecordShape(
        "`partition` int, `offset` bigint, message string",
        format="text", partition_field="partition", offset_field="offset",
    )
    return BatchIngest(tp.document_topic(spark, sf_dir), "documents", shape).rows()


def clf_decode(spark, sf_dir):
    shape = RecordShape(
        "host string, ident string, user string, time string, request string, status int, bytes bigint",
        format="clf",
    )
    return decode_topic(tp.web_log_lines(tp.table(spark, sf_dir, "pages")), shape)


def syslog_decode(spark, sf_dir):
    shape = RecordShape(
        "priority int, time string, host string, app string, pid bigint, message string", format="syslog"
    )
    return decode_topic(tp.syslog_lines(tp.table(spark, sf_dir, "events")), shape)


def pattern_decode(spark, sf_dir):
    shape = RecordShape(
        "method string, path string, query string, status int",
        format="grok",
        pattern=r'"([A-Z]+) ([^ ?]*)(?:\?([^ ]*))? HTTP/[0-9.]+" (\d+)',
    )
    return decode_topic(tp.web_log_lines(tp.table(spark, sf_dir, "pages")), shape)


def grok_decode(spark, sf_dir):
    """A pattern whose definitions refer to others, three levels deep."""
    shape = RecordShape(
        "client string, user string, verb string, target string, status int, bytes bigint",
        format="grok",
        pattern=r"%{CALLER} \[%{HTTPDATE}\] \"%{CALL}\" %{INT:status:int} %{INT:bytes:long}",
        definitions={
            "CALLER": "%{IPORHOST:client} %{NOTSPACE} %{USER:user}",
            "CALL": "%{WORD:verb} %{TARGET:target}(?: HTTP/%{NUMBER})?",
            "TARGET": "(/|%{URIPATHPARAM})",
        },
    )
    return decode_topic(tp.web_log_lines(tp.table(spark, sf_dir, "pages")), shape)


def _with_metadata(spark, sf_dir, field, **names):
    shape = RecordShape(f"{field}, {tp.EVENT_FIELDS}", format="csv", **names)
    return BatchIngest(tp.event_topic(spark, sf_dir), "events", shape).rows()


def key_column(spark, sf_dir):
    rows = _with_metadata(spark, sf_dir, "message_key binary", key_field="message_key")
    return rows.select("event_id", payload_text(F.col("message_key")).alias("message_key"))


def partition_column(spark, sf_dir):
    rows = _with_metadata(spark, sf_dir, "read_from int", partition_field="read_from")
    return rows.select("event_id", "read_from")


def offset_column(spark, sf_dir):
    rows = _with_metadata(spark, sf_dir, "read_at bigint", offset_field="read_at")
    return rows.select("event_id", "read_at")


def batch_time_column(spark, sf_dir):
    shape = RecordShape(f"read_time bigint, {tp.EVENT_FIELDS}", format="csv", time_field="read_time")
    output = tp.scratch(spark, "batch-time")
    log = tp.event_topic(spark, sf_dir)
    query = start_ingest(log, "events", shape, f"{output}/rows", f"{output}/checkpoint", FROM_START, ONCE)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p.numInputRows > 0]
    rows = spark.read.parquet(f"{output}/rows")
    return rows.agg(
        F.count("read_time").alias("stamped_rows"),
        (F.count_distinct("read_time") <= len(batches)).alias("one_time_per_batch"),
    )


def schema_shaping(spark, sf_dir):
    shape = RecordShape(
        "k binary, event_id bigint, p int, user_id int, event_type string, o bigint, value decimal(12,2)",
        format="csv", key_field="k", partition_field="p", offset_field="o",
    )
    rows = BatchIngest(tp.event_topic(spark, sf_dir), "events", shape).rows()
    return rows.withColumn("k", payload_text(F.col("k")))


def null_normalisation(spark, sf_dir):
    documents = tp.table(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(tp.table(spark, sf_dir, "labels"), "doc_id", "left")
    quality = F.col("quality").cast("string").cast("binary")
    messages = labelled.select(
        F.when(quality.isNotNull(), F.col("doc_id").cast("string")).cast("binary").alias("key"),
        quality.alias("value"),
    )
    rows = decode_topic(messages, RecordShape("k binary, body binary", key_field="k"))
    return rows.select(payload_text(F.col("k")).alias("k"), payload_text(F.col("body")).alias("body"))


# Publishing


def publish_rows(spark, sf_dir):
    """Two appends to one topic: finished orders first, then all others."""
    orders = tp.table(spark, sf_dir, "orders")
    log = TopicTable(spark, tp.scratch(spark, "orders"))
    finished = F.col("o_orderstatus") == "F"
    for part in (orders.filter(finished), orders.filter(~finished)):
        messages = to_messages(
            part, "orders", key="o_orderpriority", columns=orders.columns, arrival="o_orderkey"
        )
        publish(messages, log, 8)
    return _text_rows(log.rows())


def wide_topic(spark, sf_dir):
    """Two appends to a topic of several hundred partitions, some of which only the second one reaches."""
    return _text_rows(tp.wide_topic(spark, sf_dir).rows())


def large_bodies(spark, sf_dir):
    """Whole texts keyed by their language, so that one partition is hot, with blocks of 1 MB."""
    rows = tp.table(spark, sf_dir, "documents")
    log = TopicTable(spark, tp.scratch(spark, "large"), block_bytes=1 << 20)
    publish(to_messages(rows, "texts", key="lang", columns=["text"], arrival="doc_id"), log, 64)
    digest = F.md5(payload_text(F.col("value"))).alias("digest")
    return log.rows("texts").select("partition", "offset", payload_text(F.col("key")).alias("key"), digest)


def csv_bodies(spark, sf_dir):
    messages = to_messages(tp.table(spark, sf_dir, "orders"), "orders", body="csv")
    return messages.select(payload_text(F.col("value")).alias("body"))


def json_bodies(spark, sf_dir):
    messages = to_messages(tp.table(spark, sf_dir, "orders"), "orders", body="JSON")
    return messages.select(payload_text(F.col("value")).alias("body"))


def keyed_messages(spark, sf_dir):
    messages = to_messages(tp.table(spark, sf_dir, "orders"), "orders", key="o_orderpriority")
    return messages.select(payload_text(F.col("key")).alias("key"), payload_text(F.col("value")).alias("body"))


def keyless_messages(spark, sf_dir):
    orders = tp.table(spark, sf_dir, "orders")
    messages = to_messages(orders, "orders", columns=orders.columns, arrival="o_orderkey")
    return with_partition(messages, 8).select(
        F.col("key").isNull().alias("keyless"), "partition", payload_text(F.col("value")).alias("body")
    )


def partitioner(spark, sf_dir):
    events = tp.table(spark, sf_dir, "events")
    key = F.col("user_id").cast("string")
    return events.select("event_id", *[string_partition(key, n).alias(f"of_{n}") for n in (4, 7, 1000)])


def _labelled(spark, sf_dir):
    documents = tp.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(tp.table(spark, sf_dir, "labels"), "doc_id", "left")


def alert_publish(spark, sf_dir):
    _, unlabelled = split_on_null(_labelled(spark, sf_dir), ["quality"])
    log = TopicTable(spark, tp.scratch(spark, "alerts"))
    publish(alert_messages(alerts(unlabelled, "nullAlert", ["doc_id", "lang"]), "alerts"), log, 2)
    return log.rows("alerts").select(
        "topic", F.col("key").isNull().alias("keyless"), payload_text(F.col("value")).alias("body")
    )


def alert_routing(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    log = TopicTable(spark, tp.scratch(spark, "routed"))
    publish(route_on_null(rows, ["quality", "toxic"], "labelled", "alerts", "nullAlert", key="lang"), log, 2)
    return log.rows().select("topic", payload_text(F.col("key")).alias("key"), payload_text(F.col("value")).alias("body"))


def streaming_publish(spark, sf_dir):
    """The event stream published again, keyed by event type: few keys, hot partitions."""
    source = tp.event_topic(spark, sf_dir)
    folder = tp.scratch(spark, "stream-publish")
    target = TopicTable(spark, f"{folder}/log")
    events = decode_topic(source.stream(), tp.EVENT_SHAPE)
    messages = to_messages(events, "by_type", key="event_type", columns=tp.EVENT_COLUMNS, arrival="event_id")
    stream_publish(messages, target, f"{folder}/checkpoint", 3, ONCE).awaitTermination()
    return _text_rows(target.rows())


# Streaming


def stream_decode(spark, sf_dir):
    folder = tp.scratch(spark, "stream-decode")
    source = tp.event_topic(spark, sf_dir)
    start_ingest(
        source, "events", tp.PLACED_EVENT_SHAPE, f"{folder}/rows", f"{folder}/checkpoint", FROM_START, ONCE
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


def stream_restart(spark, sf_dir):
    """A stream that is stopped, then started again after the topic has grown."""
    folder = tp.scratch(spark, "stream-restart")
    log = TopicTable(spark, f"{folder}/log")
    events = tp.table(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "view")
    for part in (events.filter(early), events.filter(~early)):
        publish(tp.event_messages(part), log, tp.EVENT_PARTITIONS)
        start_ingest(
            log, "events", tp.PLACED_EVENT_SHAPE, f"{folder}/rows", f"{folder}/checkpoint", FROM_START, ONCE
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


def _tracked(spark, sf_dir, folder, write=None, max_files=None):
    """Tracked ingest of the event topic, each batch in a folder of its own."""
    return TrackedIngest(
        tp.event_topic(spark, sf_dir),
        "events",
        tp.PLACED_EVENT_SHAPE,
        write or (lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")),
        f"{folder}/source.events",
        FROM_START,
        max_files=max_files,
    )


def state_commit(spark, sf_dir):
    folder = tp.scratch(spark, "state-commit")
    ingest = _tracked(spark, sf_dir, folder, lambda rows, _: rows.write.format("noop").mode("overwrite").save())
    ingest.start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    return load_offsets(spark, ingest.state_path, "events")


def state_resume(spark, sf_dir):
    folder = tp.scratch(spark, "state-resume")
    ingest = _tracked(spark, sf_dir, folder)
    halfway = _fraction(ingest.source.bounds(), 1, 2)
    save_offsets(spark, ingest.state_path, off.collect_offsets(halfway))
    ingest.start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


def failure_replay(spark, sf_dir):
    """The second batch fails after writing its rows; a new run with the same checkpoint reads them again."""
    folder = tp.scratch(spark, "failure-replay")
    ingest = _tracked(spark, sf_dir, folder, max_files=2)
    write = ingest.write

    def fail_second(rows, batch):
        write(rows, batch)
        if batch > 0:
            raise RuntimeError("failed after writing")

    ingest.write = fail_second
    try:
        ingest.start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    except StreamingQueryException:
        _tracked(spark, sf_dir, folder, max_files=2).start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


def islands_of_clicks(spark, sf_dir):
    """Runs of consecutive offsets that hold clicks."""
    events = decode_topic(tp.event_topic(spark, sf_dir).rows("events"), tp.PLACED_EVENT_SHAPE)
    return offset_islands(events.filter("event_type = 'click'").withColumn("topic", F.lit("events")))


def interleaved_state(spark, sf_dir):
    """Saved offsets of a topic whose files hold every other offset of each partition, read file by file."""
    folder = tp.scratch(spark, "interleaved")
    even = F.pmod("offset", F.lit(2)) == 0
    log = _copied(spark, sf_dir, "halves", ~even, even)
    write = lambda rows, _: rows.write.format("noop").mode("overwrite").save()
    ingest = TrackedIngest(log, "events", tp.PLACED_EVENT_SHAPE, write, f"{folder}/state", FROM_START, max_files=1)
    ingest.start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    return load_offsets(spark, ingest.state_path, "events")


def replay_anew(spark, sf_dir):
    """The second batch fails after writing its rows; a new run with a new checkpoint leaves out what is written."""
    folder = tp.scratch(spark, "replay-anew")
    batches = []

    def write(rows, batch):
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")
        batches.append(batch)
        if len(batches) == 2:
            raise RuntimeError("failed after writing")

    ingest = _tracked(spark, sf_dir, folder, write, max_files=1)
    ingest.written = lambda: spark.read.parquet(f"{folder}/rows") if batches else None
    try:
        ingest.start_stream(f"{folder}/checkpoint", ONCE).awaitTermination()
    except StreamingQueryException:
        ingest.start_stream(f"{folder}/another", ONCE).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


def rate_plan(spark, sf_dir):
    log = tp.event_topic(spark, sf_dir)
    state = f"{tp.scratch(spark, 'rate-plan')}/source.events"
    ingest = TrackedIngest(
        log, "events", tp.EVENT_SHAPE, lambda rows, tick: None, state, FROM_START, rate=100, interval_seconds=2.5
    )
    bounds = log.bounds()
    cap = {(r.topic, r.partition): r.end_offset for r in ingest.plan()}
    ends = off.offset_table(spark, "events", {p: end for (_, p), end in cap.items()})
    return plan_ranges(off.earliest_offsets(bounds), bounds).drop("end_offset").join(
        ends.withColumnRenamed("offset", "end_offset"), ["topic", "partition"]
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s1_bounded_scan": bounded_scan,
    "s2_stream_scan": stream_scan,
    "s3_partition_select": partition_select,
    "s4_topic_sample": topic_sample,
    "s5_topic_catalogue": topic_catalogue,
    "s5_topic_lookup": topic_lookup,
    "f1_earliest_offsets": earliest,
    "f2_latest_offsets": latest,
    "f2_segment_index": segment_index,
    "f3_start_policy": start_policy,
    "f4_start_override": start_override,
    "f5_sentinel_substitution": sentinel_substitution,
    "f6_batch_start": batch_start,
    "f7_range_plan": range_plan,
    "f8_range_read": range_read,
    "f8_many_ranges": many_ranges,
    "f8_offset_audit": offset_audit,
    "f9_resume": resume,
    "f10_saved_offset_check": saved_offset_check,
    "f11_state_load": state_load,
    "f12_state_save": state_save,
    "f13_backlog_estimate": backlog_estimate,
    "p1_raw_payload": raw_payload,
    "p2_csv_decode": csv_decode,
    "p3_tsv_decode": tsv_decode,
    "p4_text_decode": text_decode,
    "p5_clf_decode": clf_decode,
    "p6_syslog_decode": syslog_decode,
    "p7_pattern_decode": pattern_decode,
    "p7_grok_decode": grok_decode,
    "p8_key_column": key_column,
    "p9_partition_column": partition_column,
    "p10_offset_column": offset_column,
    "p11_batch_time_column": batch_time_column,
    "p12_schema_shaping": schema_shaping,
    "p13_null_normalisation": null_normalisation,
    "k1_publish_rows": publish_rows,
    "k1_wide_topic": wide_topic,
    "k1_large_bodies": large_bodies,
    "k2_csv_body": csv_bodies,
    "k3_json_body": json_bodies,
    "k4_keyed_messages": keyed_messages,
    "k5_keyless_messages": keyless_messages,
    "k6_string_partitioner": partitioner,
    "k7_alert_publish": alert_publish,
    "k8_alert_routing": alert_routing,
    "k9_stream_publish": streaming_publish,
    "t1_stream_decode": stream_decode,
    "t2_stream_restart": stream_restart,
    "t3_state_commit": state_commit,
    "t3_offset_islands": islands_of_clicks,
    "t3_interleaved_state": interleaved_state,
    "t4_state_resume": state_resume,
    "t5_failure_replay": failure_replay,
    "t5_replay_anew": replay_anew,
    "t6_rate_plan": rate_plan,
}
