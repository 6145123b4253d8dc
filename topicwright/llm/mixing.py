"""Mixing sources to target weights by capped water-filling, with whole and fractional repetitions.

A mix shares a budget of words among sources in proportion to their weights. A source whose share is above `epochs` times its
size is clamped there, and what it leaves is shared among the others by weight, again and again until none is above. Each
round is one aggregation over the table of sources; only its sums come to the driver.

A source with a target of r times its size takes every document floor(r) times, and the rest of the target from a seeded
order of its documents: documents come whole until the target is reached, and the one in which it is reached gives its first words
only. The order is that of a hash. Its first bits cut each source into BUCKETS of about the same size, whose sizes are
summed up before any order is needed; only the one bucket in which the target is reached is put in order. So a source
that holds a third of all rows is never in one task.

Null texts have no words and take none. Null is a source of its own. Documents are told apart by id, size and text; rows
that are equal in all three share the same place in the order and are taken alike up to one row's size. An empty table
gives an empty mix. A budget above what all sources may give is cut to that; sources without a weight, or with a weight of 0 or less, get
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicwright.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"
#: Hash ranges that each source is cut into, a power of two.
BUCKETS = 4096


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def ranked(sources: DataFrame) -> DataFrame:
    """Rows of distinct sources with `rank`, their place from 0 by code point, null last.

    Ranges of sources are numbered on their own and moved by the sizes of the ranges before.
    """
    last = F.col("source").isNull()
    dealt = sources.repartitionByRange(last, "source").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "sources")
    before = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    return dealt.withColumn("inside", inside).join(before, "part").withColumn("rank", F.col("inside") + F.col("before")).drop("part", "inside", "before")


def water_fill(sources: DataFrame, budget: float, epochs: float) -> DataFrame:
    """Sources (source, source_size, weight) with `target`, the words that the mix takes from each."""
    sources = written(sources.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)), "weights")
    cap = F.col("source_size") * F.lit(float(epochs))
    level = 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) >= cap
        full, open_weight, most = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(F.col("weight") > 0, cap).otherwise(0.0)),
        ).first()
        if not open_weight or budget >= most:
            level = float("inf") if budget >= (most or 0) else level
            break
        raised = (budget - full) / open_weight
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    share = F.least(F.col("weight") * F.lit(level), cap) if level != float("inf") else cap
    return sources.withColumn("target", F.when(F.col("weight") > 0, share).otherwise(0.0))


def placed(documents: DataFrame, seed: int) -> DataFrame:
    """Documents (doc_id bigint, source string, text string) with `_place`: size in words, hash and bucket in the seeded order."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    hash_ = F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), text_hash))
    place = F.struct(
        words(F.col("text")).alias("size"),
        hash_.alias("hash"),
        F.pmod(hash_, F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        text_hash.alias("text_hash"),
    )
    return documents.withColumn("_place", place)


def cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """One row (`_mix`) for each source of the target table: its figures, whole repetitions, and the bucket that its target cuts.

    Of rows (source, _place) and targets (source, source_size, target).
    """
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("bigint")
    sources = targets.select(F.col("source").alias("_source"), "source_size", "target", whole.alias("whole"))
    part = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint")
    sources = sources.withColumn("part", part)
    buckets = rows.groupBy("source", F.col("_place.bucket").alias("bucket")).agg(F.sum("_place.size").alias("held"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    # The first bucket that is not taken whole.
    edge = buckets.join(sources, F.expr("source <=> _source")).where("before + held > part")
    edge = edge.groupBy(F.col("_source").alias("_edge")).agg(F.min(F.struct("bucket", "before")).alias("edge"))
    sources = sources.join(edge, F.expr("_source <=> _edge"), "left").drop("_edge")
    return sources.select(F.struct(*sources.columns).alias("_mix"))


def taken(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (source, _place, others) with their source's `_mix` and `_extra`, the words taken beyond whole repetitions."""
    joined = rows.join(sources, F.expr("source <=> _mix._source"))
    at_edge = F.coalesce(F.col("_place.bucket") == F.col("_mix.edge.bucket"), F.lit(False))
    order = Window.partitionBy("source").orderBy("_place.hash", "_place.id", "_place.size", "_place.text_hash")
    earlier = F.coalesce(F.sum("_place.size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = F.col("_mix.part") - F.col("_mix.edge.before") - earlier
    cut = joined.where(at_edge).withColumn("_extra", F.least(F.greatest(room, F.lit(0)), F.col("_place.size")))
    taken_whole = F.col("_place.bucket") < F.coalesce("_mix.edge.bucket", F.lit(BUCKETS))
    clear = joined.where(~at_edge).withColumn("_extra", F.when(taken_whole, F.col("_place.size")).otherwise(0))
    return clear.union(cut)


def mix_documents(
    documents: DataFrame, weights: DataFrame | None, share: float, epochs: float, seed: int, whole_rows: bool = False
) -> DataFrame:
    """Every row of documents as (doc_id, source, size, source_size, target, whole, extra, taken).

    `share` of the words of all documents is the budget. `weights` is a table (source, weight), null source included; without it
    sources by code point, null last, weigh 3, 1, 2, repeating. `taken` is `whole` times the size and the `extra` first words.
    With `whole_rows`, all columns of documents come before these; theirs give way where names are the same.
    """
    needed = documents.select("doc_id", "source", "text")
    rows = written(placed(needed, seed).drop("text"), "sizes")
    sources = rows.groupBy("source").agg(F.sum("_place.size").alias("source_size"))
    if weights is None:
        cycle = F.array(*map(F.lit, (3.0, 1.0, 2.0)))
        weight = F.element_at(cycle, (F.pmod("rank", F.lit(3)) + 1).cast("int"))
        sources = ranked(sources).withColumn("weight", weight).drop("rank")
    else:
        given = weights.select(F.col("source").alias("_given"), F.col("weight").cast("double").alias("weight"))
        sources = sources.join(given, F.expr("source <=> _given"), "left").drop("_given").fillna(0.0, ["weight"])
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    edges = written(cuts(rows, water_fill(sources, share * total, epochs)), "edges")
    mixed = taken(placed(documents, seed) if whole_rows else rows, edges)
    figures = {
        "size": F.col("_place.size"),
        "source_size": F.col("_mix.source_size"),
        "target": F.col("_mix.target"),
        "whole": F.col("_mix.whole"),
        "extra": F.col("_extra"),
        "taken": F.col("_mix.whole") * F.col("_place.size") + F.col("_extra"),
    }
    own = [c for c in documents.columns if c.lower() not in figures] if whole_rows else ["doc_id", "source"]
    return mixed.select(*own, *(c.alias(name) for name, c in figures.items()))
