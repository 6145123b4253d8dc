"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from topicwright.operators.publish import publish, to_messages
from topicwright.plans import topics as tp
from topicwright.plans.queries import QUERIES
from topicwright.sources.topic_log import TopicTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Writing to a topic is timed on its own below; these read topics that are already there.
READS = [
    "s1_bounded_scan", "s3_partition_select", "s4_topic_sample", "s5_topic_catalogue",
    "f2_latest_offsets", "f7_range_plan", "f8_range_read", "f10_saved_offset_check", "f8_many_ranges",
    "p1_raw_payload", "p2_csv_decode", "p3_tsv_decode", "p4_text_decode", "p5_clf_decode",
    "p6_syslog_decode", "p7_pattern_decode", "p12_schema_shaping",
    "k2_csv_body", "k3_json_body", "k6_string_partitioner", "k8_alert_routing",
]
WRITES = ["k1_publish_rows", "k9_stream_publish", "t1_stream_decode", "t3_state_commit", "t5_failure_replay"]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def to_nowhere(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def publish_events():
        log = TopicTable(spark, tp.scratch(spark, "bench"))
        publish(tp.event_messages(tp.table(spark, SF_DIR, "events")), log, tp.EVENT_PARTITIONS)

    # Several input files and many partitions, so that the payload is shuffled twice.
    files = f"{tp.scratch(spark, 'bench')}-lines"
    # Order and line number do not identify a line in these tables, so the arrival is given once.
    lines = tp.table(spark, SF_DIR, "lineitem").withColumn("arrival", F.monotonically_increasing_id())
    lines.repartition(16).write.parquet(files)

    def publish_lines():
        rows = spark.read.parquet(files)
        key = F.col("l_suppkey").cast("string").alias("key")
        rows = rows.select("*", key)
        log = TopicTable(spark, tp.scratch(spark, "bench"))
        publish(to_messages(rows, "lines", key="key", arrival="arrival"), log, 64)

    times["publish_lines"] = seconds(publish_lines)
    publish_events()
    times["publish_events"] = min(seconds(publish_events) for _ in range(RUNS))
    for name in READS:
        to_nowhere(QUERIES[name](spark, SF_DIR))
        times[name] = min(seconds(lambda: to_nowhere(QUERIES[name](spark, SF_DIR))) for _ in range(RUNS))
    for name in WRITES:
        to_nowhere(QUERIES[name](spark, SF_DIR))
        times[name] = seconds(lambda: to_nowhere(QUERIES[name](spark, SF_DIR)))

    events = tp.table(spark, SF_DIR, "events").count()
    result = {
        "metric": "sum of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {
            name: round(events / times[name])
            for name in ("publish_events", "s1_bounded_scan", "p2_csv_decode", "p6_syslog_decode")
        },
    }
    print(json.dumps(result), file=sys.stdout, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
