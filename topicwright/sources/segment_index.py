"""What each segment of a topic table holds, from small files that appends leave, and from Parquet footers where these are missing.

After an append, the first and last offset, the number of messages and the bytes of each segment that it touched are written to
``_segments`` in the table's folder, with a mark made of the names of the segment's files. Files in a table never change, so a
segment whose files have another mark was changed since, and its footers are read instead: an entry that is lost, late or
left over from a crash costs time, but never changes a result. Listing the files is needed for any read, so it comes for free.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.operators.offsets import local_table
from topicwright.operators.ranges import segment_number

FOLDER = "_segments"
# From so many files on, the entries of a topic are put into one file.
MANY_FILES = 64

_SCHEMA = pa.schema(
    [
        ("topic", pa.string()),
        ("partition", pa.int32()),
        *[(name, pa.int64()) for name in ("segment", "files", "mark", "first", "last", "messages", "bytes")],
    ]
)
_DDL = "topic string, partition int, segment bigint, files bigint, mark bigint, first bigint, last bigint, messages bigint, bytes bigint"
_FILE = re.compile(r"/topic=([^/]*)/partition=(\d+)/segment=(\d+)/([^/]+)$", re.MULTILINE)

Place = tuple[str, int, int]


class Segment(NamedTuple):
    """One segment folder. ``bytes`` is unknown (None) where only the footers were read."""

    topic: str
    partition: int
    segment: int
    files: int
    mark: int
    first: int
    last: int
    messages: int
    bytes: int | None


@lru_cache(maxsize=4096)
def escaped(spark: SparkSession, topic: str) -> str:
    """A topic's name as Spark writes it in the name of its folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(topic)


def listed_segments(rows: DataFrame) -> dict[Place, tuple[int, int]]:
    """The number of files and the mark of each segment, from the listing that the frame has made already."""
    jvm = rows.sparkSession._jvm
    names = jvm.org.apache.hadoop.util.StringUtils.join("\n", rows._jdf.inputFiles())
    found: dict[Place, tuple[int, int]] = {}
    for topic, partition, segment, name in _FILE.findall(names):
        place = (unquote(unquote(topic)), int(partition), int(segment))
        files, mark = found.get(place, (0, 0))
        digest = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=7).digest())
        found[place] = (files + 1, (mark + digest) % (1 << 62))
    return found


def stored_segments(spark: SparkSession, path: str, topic: str | None = None) -> list[Segment]:
    """All entries (of one topic); outdated ones are among them."""
    reader = spark.read.schema(_DDL)
    folder = f"{path}/{FOLDER}"
    try:
        if topic is None:
            rows = reader.parquet(folder)
        else:
            rows = reader.option("basePath", folder).parquet(f"{folder}/topic={escaped(spark, topic)}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [Segment(*row) for row in rows.select(*_SCHEMA.names).collect()]


def footer_segments(rows: DataFrame, listed: Mapping[Place, tuple[int, int]]) -> list[Segment]:
    """The same from the footers of the rows' files, in a session that takes min, max and count from them."""
    parts = rows.groupBy("topic", "partition", "segment").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("messages")
    )
    found = []
    for topic, partition, segment, first, last, messages in parts.collect():
        files, mark = listed.get((topic, partition, segment), (0, 0))
        found.append(Segment(topic, partition, segment, files, mark, first, last, messages, None))
    return found


def wanted_places(listed: Iterable[Place], known: Mapping[tuple[str, int], int]) -> set[Place]:
    """Segments that may hold offsets from the known ones on, and all of other partitions."""
    return {x for x in listed if x[2] >= segment_number(known.get(x[:2], 0))}


def with_bytes(spark: SparkSession, path: str, segments: Iterable[Segment]) -> list[Segment]:
    """Segments with the size of their folders: one call to the file system for each that has none yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    sized = []
    for s in segments:
        if s.bytes is None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{place_folder(spark, s[:3])}")
            s = s._replace(bytes=files.getContentSummary(folder).getLength())
        sized.append(s)
    return sized


def place_folder(spark: SparkSession, place: Place) -> str:
    topic, partition, segment = place
    return f"topic={escaped(spark, topic)}/partition={partition}/segment={segment}"


def store_segments(spark: SparkSession, path: str, new: list[Segment]) -> None:
    """Add entries; where a topic has many files of them, the newest ones of all its segments replace them."""
    if not new:
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    outdated, rows = [], list(new)
    for topic in sorted({s.topic for s in new}):
        own = spark._jvm.org.apache.hadoop.fs.Path(folder, f"topic={escaped(spark, topic)}")
        held = [f.getPath() for f in files.listStatus(own)] if files.exists(own) else []
        if len(held) >= MANY_FILES:
            # Files are only ever added to a segment, so its newest entry has the most.
            stored = {s[:3]: s for s in sorted(stored_segments(spark, path, topic), key=lambda s: s.files)}
            places = {s[:3] for s in new}
            rows += [s for place, s in stored.items() if place not in places]
            outdated += held
    table = local_table(spark, rows, _SCHEMA).coalesce(1)
    table.write.mode("append").partitionBy("topic").parquet(f"{path}/{FOLDER}")
    for file in outdated:
        files.delete(file, False)
