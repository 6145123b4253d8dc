"""A batch run over a topic: plan, read, decode, write, remember."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from topicwright.functions.shape import RecordShape
from topicwright.operators.decode import decode_topic
from topicwright.operators.offsets import OffsetError, batch_start, offset_table, select_partitions
from topicwright.operators.ranges import OffsetRange, check_whole, collect_ranges, plan_ranges
from topicwright.operators.state import State, offsets_file, read_state, save_state


@dataclass
class BatchIngest:
    """Reads each partition from its saved, configured or earliest offset up to the latest.

    With an ``offset_folder`` the end of each range is saved after a successful run, and
    the next run continues there. A preview neither loads nor saves offsets.
    """

    source: object
    topic: str
    shape: RecordShape
    partitions: Iterable[int] = ()
    initial_offsets: Mapping[int, int] = field(default_factory=dict)
    max_records: int | None = None
    offset_folder: str | None = None
    namespace: str = "default"
    pipeline: str = "ingest"
    preview: bool = False
    allow_gaps: bool = False

    @property
    def state_path(self) -> str | None:
        if self.offset_folder is None or self.preview:
            return None
        return offsets_file(self.offset_folder, self.namespace, self.pipeline)

    @cached_property
    def saved(self) -> State:
        """The state that this run goes on from, read once: saving fails if another run has saved since."""
        return (read_state(self.source.spark, self.state_path) if self.state_path else None) or State()

    @cached_property
    def ranges(self) -> list[OffsetRange]:
        """The plan of this run, made once."""
        spark = self.source.spark
        saved = self.saved.offsets
        bounds = select_partitions(self._bounds(saved), self.partitions)
        configured = offset_table(spark, self.topic, self.initial_offsets)
        starts = batch_start(bounds, configured, offset_table(spark, self.topic, saved))
        ranges = collect_ranges(plan_ranges(starts, bounds, self.max_records))
        beyond = [r for r in ranges if saved.get(r.partition, 0) > r.end_offset]
        if beyond:
            places = ", ".join(f"{r.partition} (saved {saved[r.partition]}, latest {r.end_offset})" for r in beyond)
            raise OffsetError(f"Saved offsets of topic {self.topic} are beyond the latest in partitions {places}.")
        if not self.allow_gaps:
            check_whole(ranges, bounds, self.source.dense)
        return ranges

    def _bounds(self, saved: Mapping[int, int]) -> DataFrame:
        known = {(self.topic, partition): offset for partition, offset in saved.items()}
        bounds = self.source.bounds(self.topic, known)
        found = {row.partition for row in bounds.select("partition").collect()}
        # Nothing from a saved offset on: its partition's bounds lie before it.
        return bounds if found.issuperset(saved) else self.source.bounds(self.topic)

    def messages(self) -> DataFrame:
        return self.source.read(self.ranges)

    def rows(self) -> DataFrame:
        return decode_topic(self.messages(), self.shape)

    def run(self, write: Callable[[DataFrame], None]) -> None:
        """Hand the rows to ``write``; save the new offsets only if it succeeds."""
        write(self.rows())
        self.commit()

    def commit(self) -> None:
        if self.state_path and self.ranges:
            ends = {r.partition: r.end_offset for r in self.ranges}
            save_state(self.source.spark, self.state_path, self.saved, ends)
