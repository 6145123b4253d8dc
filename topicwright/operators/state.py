"""Offset files: where the next run continues. A small JSON file for each save of a pipeline, numbered.

A save writes a new file with the next number, which fails if another saver has taken that number since the state was read. The
last file counts; there is one at any time, as old ones only go when newer ones are there. A plain file without a number
counts as the state before the first save.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Mapping
from contextlib import closing
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from topicwright.operators.islands import Intervals, PackedIntervals
from topicwright.operators.offsets import OffsetError, offset_table


# The name of the field and the ending of the file that offsets are saved in.
FIELD = "partitionOffsets"
ENDING = ".offsets.json"

# Numbered files that stay beside the last one.
KEPT = 4
# A save that merges over whatever is there tries so many times.
TRIES = 10


class StateConflict(OffsetError):
    """Another run has saved offsets since these were read."""


@dataclass(frozen=True)
class State:
    """Saved offsets, what was read beyond them, and the number of the file that says so (0: none, or the plain one)."""

    offsets: dict[int, int] = field(default_factory=dict)
    # Offsets behind a gap that were read already.
    ahead: Intervals | PackedIntervals = field(default_factory=dict)
    # Added to the ids of a stream's batches.
    first_batch: int = 0
    version: int = 0


def offsets_file(folder: str, namespace: str, pipeline: str) -> str:
    return f"{folder.rstrip('/')}/{namespace}.{pipeline}{ENDING}"


def read_state(spark: SparkSession, path: str) -> State | None:
    """The state saved at ``path``, or None if there is none.

    A malformed plain file fails: taken as empty, it would mean reading the topic anew. Of the numbered files the last whole one counts.
    """
    numbers = _numbers(spark, path)
    for number in sorted(numbers, reverse=True):
        text = _read(spark, _numbered(path, number))
        state = None if text is None else _parsed(text)
        if state is not None:
            return State(**state, version=max(numbers))
    text = _read(spark, path)
    if text is None:
        return None
    state = _parsed(text)
    if state is None:
        raise OffsetError(f"Malformed offsets in {path}")
    return State(**state, version=max(numbers, default=0))


def read_offsets(spark: SparkSession, path: str) -> dict[int, int] | None:
    """Partition-to-offset mapping saved at ``path``, or None if there is none."""
    state = read_state(spark, path)
    return None if state is None else state.offsets


def load_offsets(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The saved offsets as an offset map; empty if none were saved."""
    return offset_table(spark, topic, read_offsets(spark, path) or {})


def save_state(
    spark: SparkSession,
    path: str,
    read: State | None,
    offsets: Mapping[int, int],
    ahead: Intervals | PackedIntervals | None = None,
    first_batch: int | None = None,
) -> State:
    """Merge the offsets over the state that was read and save it; fails if that is no longer the last one."""
    read = read or State()
    state = State(
        read.offsets | dict(offsets),
        PackedIntervals.of(read.ahead if ahead is None else ahead),
        read.first_batch if first_batch is None else first_batch,
        read.version + 1,
    )
    if not _create(spark, _numbered(path, state.version), _text(state)):
        raise StateConflict(f"Another run has saved offsets to {path} since they were read (version {read.version}).")
    for number in _numbers(spark, path):
        if number < state.version - KEPT:
            _delete(spark, _numbered(path, number))
    return state


def save_offsets(spark: SparkSession, path: str, offsets: Mapping[int, int]) -> State:
    """Merge the offsets over whatever is saved, also over what others save at the same time."""
    for _ in range(TRIES - 1):
        try:
            return save_state(spark, path, read_state(spark, path), offsets)
        except StateConflict:
            continue
    return save_state(spark, path, read_state(spark, path), offsets)


def _text(state: State) -> str:
    content: dict = {FIELD: {str(p): state.offsets[p] for p in sorted(state.offsets)}}
    if state.ahead:
        content["ahead"] = PackedIntervals.of(state.ahead).content()
    if state.first_batch:
        content["firstBatch"] = state.first_batch
    return json.dumps(content, separators=(",", ":"))


def _parsed(text: str) -> dict | None:
    try:
        content = json.loads(text)
        return {
            "offsets": {int(p): int(offset) for p, offset in content[FIELD].items()},
            "ahead": PackedIntervals.parsed(content.get("ahead", {})),
            "first_batch": int(content.get("firstBatch", 0)),
        }
    except (AttributeError, KeyError, TypeError, ValueError, zlib.error):
        return None


def _numbered(path: str, number: int) -> str:
    return f"{path}.versions/{number:012d}"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, files = _files(spark, f"{path}.versions")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [int(name) for name in names if name.isdigit()]


def _read(spark: SparkSession, path: str) -> str | None:
    target, files = _files(spark, path)
    if not files.exists(target):
        return None
    with closing(files.open(target)) as stream:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")


def _delete(spark: SparkSession, path: str) -> None:
    target, files = _files(spark, path)
    files.delete(target, False)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole file of that name in one step; false if there is one."""
    target, files = _files(spark, path)
    files.mkdirs(target.getParent())
    if files.exists(target):
        return False
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
