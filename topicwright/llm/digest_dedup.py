"""Exact dedup against a history, looked up in minimal perfect hashes.

The distinct digests of the history are dealt to shards by their first bits. Each shard gets a minimal perfect hash: bits on
several levels, each level taking the digests that met no other at their place, so that the rank of a digest's bit is
its slot among as many slots as digests. A slot holds the full digest, the locator of the copy to keep, and how many copies
there are. New digests are summed up first, so a text that a third of all rows hold is one digest; each is looked up
in its shard and compared with the slot byte by byte. Members join their slot's group. Nonmembers form groups of
their own.

Null texts count as empty ones, and all empty texts are copies of each other. Of equal texts the row with the largest
id stays; null ids are smaller than any other; of several rows with the same text and the largest id, one stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.llm.shared import written
from topicwright.llm.sieve import passes, sieve
from topicwright.llm.text_arrays import mix

#: Digests of a shard, on average.
SHARD_DIGESTS = 1 << 14
#: Bits of a level for each digest that it has to place.
SPREAD = 1.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 with A-Z lower-cased."""
    return F.unhex(F.sha2(F.encode(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "utf-8"), 256))


def digest_words(digests: pa.Array) -> np.ndarray:
    """Each 32-byte digest as four numbers."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)


class PerfectHash:
    """Distinct digests to the numbers below their count, one to one."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.append(0, np.cumsum(bits, dtype=np.int64))

    @staticmethod
    def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
        x = np.full(len(words), level + 1, np.uint64)
        for i in range(4):
            x = mix(x ^ words[:, i])
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, words: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(words):
            size = int(len(words) * SPREAD) + 1
            places = cls._places(words, len(sizes), size)
            single = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(single)
            words = words[~single[places]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest. Others get any slot, or -1."""
        result = np.full(len(words), -1, np.int64)
        waiting, base = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes.tolist()):
            places = base + self._places(words[waiting], level, size)
            set_ = self.bits[places]
            result[waiting[set_]] = self.rank[places[set_]]
            waiting, base = waiting[~set_], base + size
        return result

    def pack(self) -> bytes:
        head = np.append(len(self.sizes), self.sizes).astype("<i8").tobytes()
        return head + np.packbits(self.bits).tobytes()

    @classmethod
    def unpack(cls, packed: bytes) -> PerfectHash:
        count = int(np.frombuffer(packed, "<i8", 1)[0])
        sizes = np.frombuffer(packed, "<i8", count, 8)
        return cls(sizes, np.unpackbits(np.frombuffer(packed, np.uint8, -1, 8 * (count + 1)), count=sizes.sum()).astype(bool))


def copies(rows: DataFrame) -> DataFrame:
    """(digest, winner, copies): rows (digest, doc_id, row) summed up; the winner is the largest locator (doc_id, row)."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("winner"), F.count("*").alias("copies"))


class DigestHistory:
    """Distinct digests of a history in a stored minimal perfect hash for each shard."""

    def __init__(self, hashes: DataFrame, slots: DataFrame, shards: int):
        self.hashes, self.slots, self.shards = hashes, slots, shards

    @staticmethod
    def _shard(shards: int) -> Column:
        first = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("bigint")
        return F.floor(first * shards / F.lit(1 << 32)).cast("int")

    @classmethod
    def build(cls, history: DataFrame, expected: int) -> DigestHistory:
        """From rows (digest, winner, copies) with distinct digests; `expected` digests decide on the number of shards."""
        shards = expected // SHARD_DIGESTS + 1
        slot_kind = "shard int, slot bigint, digest binary, winner struct<doc_id: bigint, row: bigint>, copies bigint, hash binary"

        def place(rows: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
            batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            words = digest_words(batch.column("digest"))
            made = PerfectHash.of(words)
            order = np.argsort(made.slots(words))
            batch = batch.take(pa.array(order))
            shard, n = batch.column("shard")[0].as_py(), len(order)
            names = ["shard", "slot", "digest", "winner", "copies", "hash"]
            slots = [batch.column("shard"), pa.array(np.arange(n)), *(batch.column(x) for x in names[2:5]), pa.nulls(n, pa.binary())]
            head = [pa.array([shard], pa.int32()), pa.array([-1]), *(pa.nulls(1, batch.column(x).type) for x in names[2:5])]
            return [
                pa.record_batch([*head, pa.array([made.pack()], pa.binary())], names),
                pa.record_batch(slots, names),
            ]

        def run(batches):
            for rows in by_shard(batches):
                yield from place(rows)

        dealt = history.select(cls._shard(shards).alias("shard"), "digest", "winner", "copies")
        dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
        stored = written(dealt.mapInArrow(run, slot_kind), "slots")
        return cls(stored.where("slot < 0").select("shard", "hash"), stored.where("slot >= 0").drop("hash"), shards)

    def groups(self, arrivals: DataFrame) -> DataFrame:
        """(digest, winner, copies, member) of the history and of arrivals (digest, winner, copies) together.

        `member` tells whether the digest is in the history.
        """
        kind = "digest binary, winner struct<doc_id: bigint, row: bigint>, copies bigint, member boolean"
        names = ["digest", "winner", "copies", "member"]

        def larger(a, b):
            key = lambda w: (w["doc_id"] is not None, w["doc_id"] or 0, w["row"])
            return a if key(a) >= key(b) else b

        def run(batches):
            for rows in by_shard(batches):
                yield from joined(rows)

        def joined(rows):
            table = pa.Table.from_batches(rows).combine_chunks()
            part = table.column("part").to_numpy()
            head, slots, new = (table.filter(pa.array(part == i)) for i in range(3))
            words = digest_words(new.column("digest"))
            made = PerfectHash.unpack(head.column("hash")[0].as_py()) if head.num_rows else PerfectHash.of(words[:0])
            slots = slots.sort_by("slot")
            held = digest_words(slots.column("digest"))
            at = made.slots(words)
            equal = np.zeros(len(words), bool)
            equal[at >= 0] = (held[at[at >= 0]] == words[at >= 0]).all(1)
            winners, sizes = slots.column("winner").to_pylist(), slots.column("copies").to_numpy().copy()
            members = new.filter(pa.array(equal))
            for slot, winner, size in zip(at[equal].tolist(), members.column("winner").to_pylist(), members.column("copies").to_pylist()):
                winners[slot] = larger(winners[slot], winner)
                sizes[slot] += size
            kept = [slots.column("digest"), pa.array(winners, slots.schema.field("winner").type), pa.array(sizes)]
            yield from pa.table([*kept, pa.array(np.ones(len(sizes), bool))], names).to_batches()
            others = new.filter(pa.array(~equal)).select(names[:3])
            yield from others.append_column("member", pa.array(np.zeros(others.num_rows, bool))).to_batches()

        empty = "cast(null as binary) as {}"
        new = arrivals.select(self._shard(self.shards).alias("shard"), "digest", "winner", "copies")
        no_slot = "cast(null as struct<doc_id: bigint, row: bigint>) as winner"
        rows = (
            self.hashes.selectExpr("shard", "0 as part", "-1L as slot", empty.format("digest"), no_slot, "0L as copies", "hash")
            .union(self.slots.selectExpr("shard", "1 as part", "slot", "digest", "winner", "copies", empty.format("hash")))
            .union(new.selectExpr("shard", "2 as part", "-1L as slot", "digest", "winner", "copies", empty.format("hash")))
        )
        return rows.repartition(self.shards, "shard").sortWithinPartitions("shard").mapInArrow(run, kind)


def by_shard(batches):
    """Batches in the order of their shards, as the list of each shard's rows."""
    shard, rows = None, []
    for batch in batches:
        column = batch.column("shard").to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [len(column)]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high == low:
                continue
            if rows and column[low] != shard:
                yield rows
                rows = []
            shard = column[low]
            rows.append(batch.slice(int(low), int(high - low)))
    if rows:
        yield rows


def exact_groups(documents: DataFrame, in_history: Column) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row of documents (doc_id bigint, text string).

    Rows for which `in_history` holds are the history that the others are looked up in; null counts as false.
    """
    digests = documents.select(
        text_digest(F.col("text")).alias("digest"),
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(in_history, F.lit(False)).alias("old"),
    )
    digests = written(digests, "digests")
    old, new = (copies(digests.where(x)) for x in ("old", "not old"))
    expected = digests.agg(F.approx_count_distinct("digest")).first()[0]
    groups = written(DigestHistory.build(old, expected).groups(new), "groups")
    several = groups.where("copies > 1").select("digest", "winner", "copies")
    row = digests.drop("old").join(several, "digest", "left")
    return row.select(
        "doc_id",
        F.when(F.col("winner").isNull(), F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("winner.row") == F.col("row"), F.lit(True)).alias("kept"),
        "digest",
    )


def first_half(documents: DataFrame) -> Column:
    """The older half of the range of ids."""
    low, high = documents.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") <= (0 if low is None else (low + high) // 2)


def without_copies(documents: DataFrame, in_history: Column) -> DataFrame:
    """The rows of documents without those whose text another row has: of each group, the one that `exact_groups` keeps.

    Rows are matched by digest and id together, so a text that many rows hold is not in one task. A sieve of these lets
    all other rows pass without a shuffle. Other columns may have any name.
    """
    decided = written(exact_groups(documents, in_history).where("group_size > 1"), "decided")
    gone = decided.where("not (doc_id <=> keep_id)").select("digest", "doc_id").distinct()
    # Groups of which several rows have the id that stays.
    repeated = decided.where("doc_id <=> keep_id").groupBy("digest", "doc_id").agg(F.count("*").alias("times")).where("times > 1")
    gone, repeated = written(gone, "gone"), written(repeated.drop("times"), "repeated")
    mark = F.xxhash64("digest", "doc_id").alias("mark")
    held = documents.sparkSession.sparkContext.broadcast(sieve(gone.union(repeated).select(mark)))

    @F.pandas_udf("boolean")
    def may_go(marks: pd.Series) -> pd.Series:
        return pd.Series(passes(held.value, marks.to_numpy(np.int64)))

    names = documents.columns
    # Columns by number on the way, so that no name clashes.
    numbered = documents.toDF(*(f"c{i}" for i in range(len(names))))
    number, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    marked = numbered.withColumn("digest", text_digest(F.col(text)))
    marked = marked.withColumn("doubtful", may_go(F.xxhash64("digest", number)))
    same = F.expr(f"digest = of and {number} <=> id")
    pairs = lambda frame: frame.toDF("of", "id")
    rows = marked.where("doubtful").join(pairs(gone), same, "left_anti")
    if not repeated.isEmpty():
        one = rows.join(pairs(repeated), same, "left_semi").dropDuplicates(["digest"])
        rows = rows.join(pairs(repeated), same, "left_anti").union(one)
    return marked.where("not doubtful").union(rows).select(*numbered.columns).toDF(*names)
