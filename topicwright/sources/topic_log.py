"""Topics: a Parquet table of messages, or a live topic where the connector is installed."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from contextlib import closing
from dataclasses import dataclass, field
from urllib.parse import unquote
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.functions.partitioner import string_partition
from topicwright.operators.numbering import BLOCK_BYTES
from topicwright.operators.offsets import bounds_table
from topicwright.operators.publish import segmented, with_offsets
from topicwright.operators.ranges import LITERAL_RANGES, MESSAGE_BYTES, OffsetRange, read_ranges, segment_number
from topicwright.sources import segment_index as index
from topicwright.sources.segment_index import Segment

# The columns of Spark's own source for live topics, and the segment folder.
LOG_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int, segment bigint"
)

# Fixed value: messages a second and partition that a live topic is read at unless told otherwise.
DEFAULT_RATE = 1000

_footer_sessions: WeakKeyDictionary = WeakKeyDictionary()


def _footer_session(spark: SparkSession) -> SparkSession:
    """One session for each caller's in which min, max and count come from Parquet footers.

    That needs the newer reader, a choice that must not leak into the caller's settings; all other
    settings are the caller's as they are now.
    """
    session = _footer_sessions.get(spark)
    if session is None:
        session = _footer_sessions[spark] = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


@dataclass(frozen=True)
class TopicTable:
    """Topics in a Parquet table partitioned by topic, partition and segment.

    A segment holds 2^20 consecutive offsets, so reading a range of offsets only opens the
    files around it. One writer at a time may append to a topic. ``compression``: none,
    gzip, snappy or another Parquet codec. ``block_bytes``: messages of so many bytes at most are numbered in one task.
    """

    spark: SparkSession
    path: str
    compression: str = "snappy"
    block_bytes: int = BLOCK_BYTES

    # Offsets run without gaps.
    dense = True

    def rows(self, topic: str | None = None) -> DataFrame:
        """All messages (of one topic)."""
        stored = self._stored(topic)
        return self.spark.createDataFrame([], LOG_SCHEMA) if stored is None else stored

    def _stored(self, topic: str | None = None, places: Iterable[index.Place] = ()) -> DataFrame | None:
        """The stored messages (of one topic, or of some segments), or None if there is no table (or topic) yet."""
        reader = self.spark.read.schema(LOG_SCHEMA)
        folders = [f"{self.path}/{index.place_folder(self.spark, place)}" for place in places]
        if topic is not None:
            folders = folders or [self._folder(topic)]
        try:
            # Only the folders that are named are listed.
            return reader.option("basePath", self.path).parquet(*folders) if folders else reader.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _folder(self, topic: str) -> str:
        return f"{self.path}/topic={index.escaped(self.spark, topic)}"

    def stream(
        self,
        topic: str | None = None,
        starts: Mapping[int, int] | None = None,
        max_files: int | None = None,
        rate: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Messages (of one topic) as they come. ``starts`` are for live topics: a table is filtered by ``stream_from``.

        A micro-batch takes ``max_files`` files, or else as many as ``rate`` allows. Only the topic's own folder is looked at.
        """
        reader = self.spark.readStream.schema(LOG_SCHEMA).option("basePath", self.path)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        else:
            reader = reader.options(**(rate or {}))
        path = self.path if topic is None else self._folder(topic)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        # The stream takes a path that is no pattern for the base path, and would not see the topic's name.
        return reader.parquet(path if topic is None else f"{path}/partition=*")

    def rate_options(self, rate: int | None, seconds: float, partitions: int, topic: str | None = None) -> dict[str, str]:
        """Cap of a stream's micro-batch in bytes, from what a message takes on average in the segments known so far.

        Files are taken whole, so a batch has one file at least. No rate, or 0, is no cap.
        """
        if rate is not None and rate < 0:
            raise ValueError(f"The rate per partition must not be negative, but is {rate}.")
        if not rate:
            return {}
        known = [s for s in self.segments(topic) if s.bytes is not None]
        messages = sum(s.messages for s in known)
        size = sum(s.bytes for s in known) / messages if messages else MESSAGE_BYTES
        return {"maxBytesPerTrigger": str(max(1, int(rate * seconds * max(1, partitions) * size)))}

    def topics(self) -> list[str]:
        """Names of all topics, which are the names of folders; no file is opened."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(unquote(n.removeprefix("topic=")) for n in names if n.startswith("topic="))

    def segments(
        self, topic: str | None = None, known: Mapping[tuple[str, int], int] | None = None
    ) -> list[Segment]:
        """What each segment (of one topic) holds: from the index where it is up to date, else from file footers.

        ``known`` offsets of partitions (topic, partition) skip the segments before them.
        """
        rows = self._stored(topic)
        if rows is None:
            return []
        listed = index.listed_segments(rows)
        wanted = index.wanted_places(listed, known or {})
        found = {s[:3]: s for s in index.stored_segments(self.spark, self.path, topic) if s[:3] in wanted and s[3:5] == listed[s[:3]]}
        missing = wanted - set(found)
        if not missing:
            return sorted(found.values())
        footers = TopicTable(_footer_session(self.spark), self.path)
        rows = footers._stored(topic, () if len(missing) == len(listed) else sorted(missing))
        return sorted([*found.values(), *index.footer_segments(rows, listed)])

    def segment_rows(self, places: list[index.Place]) -> DataFrame:
        """The messages of some segments (topic, partition, segment); only their folders are listed."""
        rows = self._stored(None, places)
        return self.spark.createDataFrame([], LOG_SCHEMA) if rows is None else rows

    def bounds(
        self, topic: str | None = None, known: Mapping[tuple[str, int], int] | None = None
    ) -> DataFrame:
        """Offset bounds of every partition (of one topic). With ``known`` offsets they are those of the segments from there on."""
        return bounds_table(self.spark, [(*place, *row) for place, row in _rolled_up(self.segments(topic, known)).items()])

    def read(self, ranges: list[OffsetRange]) -> DataFrame:
        wanted = [r for r in ranges if r.start_offset < r.end_offset]
        topics = {r.topic for r in wanted}
        topic = topics.pop() if len(topics) == 1 else None
        rows = self.rows(topic)
        if len(wanted) > LITERAL_RANGES:
            # Beyond a literal predicate, the folders that hold the ranges are named instead.
            listed = index.listed_segments(rows)
            needed = {
                (r.topic, r.partition, segment)
                for r in wanted
                for segment in range(segment_number(r.start_offset), segment_number(r.end_offset - 1) + 1)
            }.intersection(listed)
            if len(needed) < len(listed):
                rows = self._stored(topic, sorted(needed)) if needed else rows.filter(F.lit(False))
        return read_ranges(rows, wanted)

    def append(
        self,
        messages: DataFrame,
        partitions: int | None = None,
        known: Mapping[tuple[str, int], int] | None = None,
    ) -> dict[tuple[str, int], int]:
        """Append messages behind the latest offsets; returns the latest offsets after it.

        ``known`` are such offsets from an earlier append; segments before them are not looked at.
        """
        if not partitions:
            raise ValueError("A topic table needs the number of partitions.")
        latest = self._latest(self.segments(known=known), known or {})
        rows = with_offsets(messages, partitions, latest, self.block_bytes)
        writer = segmented(rows).write.mode("append").option("compression", self.compression)
        writer.partitionBy("topic", "partition", "segment").parquet(self.path)
        after = self.segments(known=latest)
        new = index.with_bytes(self.spark, self.path, [s for s in after if s.bytes is None])
        index.store_segments(self.spark, self.path, new)
        return self._latest(after, latest)

    def _latest(self, segments: list[Segment], known: Mapping[tuple[str, int], int]) -> dict[tuple[str, int], int]:
        return dict(known) | {place: latest for place, (_, latest, _) in _rolled_up(segments).items()}


def _rolled_up(segments: list[Segment]) -> dict[tuple[str, int], tuple[int, int, int]]:
    """Earliest offset, next offset and number of messages of each partition."""
    found: dict[tuple[str, int], tuple[int, int, int]] = {}
    for s in segments:
        earliest, latest, messages = found.get(s[:2], (s.first, s.last + 1, 0))
        found[s[:2]] = (min(earliest, s.first), max(latest, s.last + 1), messages + s.messages)
    return found


@dataclass(frozen=True)
class KafkaTopic:
    """A live topic through Spark's connector, which must be on the class path."""

    spark: SparkSession
    servers: str
    topic: str
    properties: dict[str, str] = field(default_factory=dict)
    compression: str = "none"
    acknowledge_all: bool = True

    # Compaction and transactions leave gaps between offsets.
    dense = False

    def source_options(self, starts: dict[int, int] | str, partitions: list[int] | None = None) -> dict[str, str]:
        """Connector options to read from offsets per partition (or ``earliest``/``latest``)."""
        options = {"kafka.bootstrap.servers": self.servers, "failOnDataLoss": "true"}
        if partitions:
            options["assign"] = json.dumps({self.topic: sorted(set(partitions))})
        else:
            options["subscribe"] = self.topic
        options["startingOffsets"] = starts if isinstance(starts, str) else self._offsets_json(starts)
        return options | self._properties()

    def range_options(self, ranges: list[OffsetRange]) -> dict[str, str]:
        """Connector options of a batch read of exactly these ranges."""
        options = self.source_options(
            {r.partition: r.start_offset for r in ranges}, [r.partition for r in ranges]
        )
        return options | {"endingOffsets": self._offsets_json({r.partition: r.end_offset for r in ranges})}

    def rate_options(self, rate: int | None, seconds: float, partitions: int, topic: str | None = None) -> dict[str, str]:
        """Cap of a stream's micro-batch. The connector takes a total, not one per partition. No rate is DEFAULT_RATE, 0 no cap."""
        rate = DEFAULT_RATE if rate is None else rate
        if rate < 0:
            raise ValueError(f"The rate per partition must not be negative, but is {rate}.")
        return {"maxOffsetsPerTrigger": str(int(rate * seconds * partitions))} if rate else {}

    def sink_options(self) -> dict[str, str]:
        """Connector options to write; the caller's own properties win."""
        options = {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            "kafka.compression.type": self.compression,
            # Fixed value: the time that a producer waits for more messages.
            "kafka.linger.ms": "100",
        }
        if not self.acknowledge_all:
            options["kafka.acks"] = "1"
        return options | self._properties()

    def rows(self) -> DataFrame:
        return self._load(self.source_options("earliest"))

    def stream(
        self,
        topic: str | None = None,
        starts: Mapping[int, int] | str | None = None,
        max_files: int | None = None,
        rate: Mapping[str, str] | None = None,
    ) -> DataFrame:
        options = self.source_options("latest" if starts is None else starts) | dict(rate or {})
        return self.spark.readStream.format("kafka").options(**options).load()

    def bounds(self, topic: str | None = None, known: Mapping | None = None) -> DataFrame:
        """Offset bounds as the brokers tell them, without reading a message; partitions that retention
        has emptied are among them. ``messages`` counts offsets, of which some may have no message."""
        with closing(self._consumer()) as consumer:
            place = self.spark._jvm.org.apache.kafka.common.TopicPartition
            parts = [place(self.topic, info.partition()) for info in consumer.partitionsFor(self.topic)]
            first, last = consumer.beginningOffsets(parts), consumer.endOffsets(parts)
            found = [(p.topic(), p.partition(), first[p], last[p]) for p in parts]
        return bounds_table(self.spark, [(*f, f[3] - f[2]) for f in found])

    def topics(self) -> list[str]:
        """Names of all topics that the brokers know, without internal ones."""
        with closing(self._consumer()) as consumer:
            return sorted(name for name in consumer.listTopics() if not name.startswith("__"))

    def _consumer(self):
        """The connector's own client, in the driver's JVM."""
        jvm = self.spark._jvm
        settings = jvm.java.util.Properties()
        bytes_ = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
        own = {"bootstrap.servers": self.servers, "key.deserializer": bytes_, "value.deserializer": bytes_}
        for name, value in (self.properties | own).items():
            settings.setProperty(name, value)
        return jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)

    def read(self, ranges: list[OffsetRange]) -> DataFrame:
        wanted = [r for r in ranges if r.start_offset < r.end_offset]
        return self._load(self.range_options(wanted)) if wanted else self.rows().filter(F.lit(False))

    def append(self, messages: DataFrame, partitions: int | None = None, known=None) -> dict:
        rows, columns = messages, ["key", "value"]
        if partitions:
            # No partition for messages without a key: the producer spreads them.
            placed = F.when(F.col("key").isNotNull(), string_partition(F.col("key").cast("string"), partitions))
            rows, columns = rows.withColumn("partition", placed), [*columns, "partition"]
        options = self.sink_options()
        if "topic" in messages.columns:
            # Messages and alerts go where they say.
            columns.append("topic")
            del options["topic"]
        rows.select(*columns).write.format("kafka").options(**options).save()
        return {}

    def _load(self, options: dict[str, str]) -> DataFrame:
        return self.spark.read.format("kafka").options(**options).load()

    def _offsets_json(self, offsets: dict[int, int]) -> str:
        return json.dumps({self.topic: {str(p): o for p, o in sorted(offsets.items())}})

    def _properties(self) -> dict[str, str]:
        return {f"kafka.{name}": value for name, value in self.properties.items()}


def open_topic(spark: SparkSession, path: str | None = None, **live) -> TopicTable | KafkaTopic:
    """A topic table at ``path``, or the live topic described by ``servers`` and ``topic``."""
    return TopicTable(spark, path) if path is not None else KafkaTopic(spark, **live)
