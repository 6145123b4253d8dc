"""Fuzzy line dedup: lines that share a block and whose SimHashes are near, verified by edit distance, then an exact check of the rest.

A line is normalised to its words of letters and digits, A-Z lower-cased and digits made 0; lines without any are left alone. Equal
normalised lines are one node. The SimHash of a node has 64 bits, each the majority of that bit in the hashes of its words.

Blocks are not taken from the bits of the SimHash: lines of edit similarity SIMILAR lie up to 16 bits apart, and blocks of so few bits
as the pigeonhole then leaves are shared by most lines of a language. They are taken from the line: the BLOCKS smallest hashes of its
runs of RUN words (a shorter line is one run). An edit changes the few runs around it, so of a line's smallest ones some mostly stay.
Nodes that share a block are compared when their SimHashes differ in at most APART bits and their lengths in characters allow a link.
That is no condition of a link: two lines link when the edit distance of their normalised texts is at most 1 - SIMILAR of the longer one's
length. Of each group connected by links, the first occurrence by document id, row and line stays.

Nodes that meet are first checked against the smallest of their block. Components over the links found are contracted, and every component
at a block asks representatives of a few others, in some rounds. So one large group of variants costs a multiple of its size. Then every pair of
lines that no component joins is compared, whether or not they share a block (`edit_join`): exact, and by nature quadratic in the number of
different lines of about a length, as edits at one character in five can leave no run of five characters whole that an index could hold.

Null texts have one empty line. Null ids come first in the order; repeated rows are rows of their own, of which the first keeps
its lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicwright.llm.edit_join import allowed, edit_links
from topicwright.llm.edits import within
from topicwright.llm.shared import components, written
from topicwright.llm.sieve import passes, sieve
from topicwright.llm.text_arrays import Texts, normalised, shingle_sets, slices

SIMILAR = 0.8
APART = 14
RUN = 4
BLOCKS = 4
#: Rounds in which representatives ask, before all pairs between components are compared.
ROUNDS = 2
#: Representatives of a block in such a round.
REPRESENTATIVES = 4
#: Lines whose runs are hashed at once.
LINES_AT_ONCE = 1 << 16
#: Whether a query's shuffle files go when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DIGITS = np.arange(256, dtype=np.uint8)
_DIGITS[48:58] = 48


def lines_of(texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray]:
    """The normalised lines, the text of each, and its number in that text."""
    breaks = np.flatnonzero(texts.data == 10) + 1
    # A text that ends with a line break has an empty last line, which begins where the next text does.
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks]), kind="stable")
    number = np.bincount(np.searchsorted(texts.offsets[1:], breaks - 1, "right"), minlength=len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), number)
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    plain, _ = normalised(Texts(_DIGITS[texts.data], np.append(starts, len(texts.data))))
    return plain, owner, number


def simhashes(lines: Texts) -> np.ndarray:
    """64 bits for each line: the majority of its words' hashes; 0 for a line without words."""
    starts, ends, owner = lines.words()
    result = np.zeros(len(lines), np.int64)
    if len(starts):
        bits = np.unpackbits(lines.hashes(starts, ends).view(np.uint8).reshape(-1, 8), axis=1)
        of, first = np.unique(owner, return_index=True)
        # Line by line is several times faster here than one reduceat over all.
        edges = np.append(first, len(owner))
        ones = np.array([bits[a:b].sum(0, dtype=np.int32) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())])
        result[of] = np.packbits(2 * ones > np.diff(edges)[:, None], axis=1).view(np.int64).ravel()
    return result


def blocks_of(lines: Texts, run: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hashes of each line's runs of words, one line after another, and where each begins."""
    values, counts = [], []
    for low in range(0, len(lines), LINES_AT_ONCE):
        edges = lines.offsets[low : low + LINES_AT_ONCE + 1]
        made, begins = shingle_sets(Texts(lines.data[edges[0] : edges[-1]], edges - edges[0]), run)
        place = np.arange(len(made)) - np.repeat(begins[:-1], np.diff(begins))
        values.append(made[place < blocks].view(np.int64))
        counts.append(np.minimum(np.diff(begins), blocks))
    joined = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (values, counts))
    values, counts = joined
    return values, np.append(0, np.cumsum(counts))


def _of(lines: Texts, taken: np.ndarray) -> Texts:
    """Some of the lines."""
    size = np.diff(lines.offsets)[taken]
    offsets = np.append(0, np.cumsum(size))
    places = np.arange(offsets[-1]) + np.repeat(lines.offsets[taken] - offsets[:-1], size)
    return Texts(lines.data[places], offsets)


def occurrences(documents: DataFrame, run_words: int, blocks: int) -> DataFrame:
    """(row, doc_id, line, node, bits, size, blocks) of each line; node is null where a line has no words.

    `size` is in characters. `bits`, `size` and `blocks` are null where a task has had the node before.
    """

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                lines, owner, number = lines_of(texts)
                node = lines.hashes(lines.offsets[:-1], lines.offsets[1:]).view(np.int64)
                empty = np.diff(lines.offsets) == 0
                fresh = np.zeros(len(lines), bool)
                each, first = np.unique(node, return_index=True)
                for key, i in zip(each.tolist(), first.tolist()):
                    if not empty[i] and key not in seen:
                        seen.add(key)
                        fresh[i] = True
                new = np.flatnonzero(fresh)
                told = _of(lines, new)
                characters = np.append(0, np.cumsum((told.data & 0xC0) != 0x80))[told.offsets]
                values, begins = blocks_of(told, run_words, blocks)
                at = pa.array(np.cumsum(fresh) - 1, mask=~fresh)
                held = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values))
                more = [pa.array(simhashes(told)), pa.array(np.diff(characters).astype(np.int32)), held]
                taken = pa.array(owner)
                columns = [rows.column("row").take(taken), rows.column("doc_id").take(taken), pa.array(number.astype(np.int32))]
                columns += [pa.array(node, mask=empty), *(x.take(at) for x in more)]
                yield pa.record_batch(columns, ["row", "doc_id", "line", "node", "bits", "size", "blocks"])

    numbered = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = "row bigint, doc_id bigint, line int, node bigint, bits bigint, size int, blocks array<bigint>"
    return numbered.mapInArrow(run, kind)


def line_texts(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of each of the nodes."""
    held = documents.sparkSession.sparkContext.broadcast(sieve(nodes.select("node")))

    def run(batches):
        for batch in batches:
            for _, texts in slices(batch, "text"):
                lines, _, _ = lines_of(texts)
                node = lines.hashes(lines.offsets[:-1], lines.offsets[1:])
                taken = np.flatnonzero(passes(held.value, node) & (np.diff(lines.offsets) > 0))
                said = pa.array([lines.bytes_of(i).decode("utf-8", "replace") for i in taken], pa.string())
                yield pa.record_batch([pa.array(node.view(np.int64)[taken]), said], ["node", "text"])

    found = documents.select("text").mapInArrow(run, "node bigint, text string")
    return found.join(nodes.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def _near(a: str, b: str, apart: int) -> str:
    ratio = f"least({a}.size, {b}.size) >= {SIMILAR} * greatest({a}.size, {b}.size)"
    return f"bit_count({a}.bits ^ {b}.bits) <= {apart} and {ratio}"


def verified(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are near by edit distance."""
    pairs = written(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = written(line_texts(documents, nodes), "texts")
    # Dealt by the number of partitions and not by bytes: comparing takes longer than shipping.
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.join(texts.selectExpr("node as a", "text as one"), "a").repartition(tasks, "b")
    both = both.join(texts.selectExpr("node as b", "text as other"), "b")

    def run(batches):
        for batch in batches:
            one, other = (batch.column(x).to_pylist() for x in ("one", "other"))
            longer = np.array([max(len(x), len(y)) for x, y in zip(one, other)], np.int64)
            near = within(one, other, allowed(longer, SIMILAR))
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return written(both.select("a", "b", "one", "other").mapInArrow(run, "a bigint, b bigint"), "links")


def _placed(met: DataFrame, parts: DataFrame) -> DataFrame:
    """The nodes under each block with their component, at blocks where several components meet."""
    placed = met.join(parts.selectExpr("node as _node", "component"), F.col("node") == F.col("_node"), "left").drop("_node")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("block").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return placed.join(several.select("block"), "block", "left_semi")


def _pair(x: str, y: str) -> list[str]:
    return [f"least({x}, {y}) as a", f"greatest({x}, {y}) as b"]


def _asked(placed: DataFrame, number: int, apart: int) -> DataFrame:
    """Pairs (a, b) of the representatives of some components at each block with the nodes of other components there."""
    told = F.max(F.struct(F.xxhash64("node", F.lit(number)).alias("order"), "node", "bits", "size"))
    chosen = placed.groupBy("block", "component").agg(told.alias("first"))
    place = F.row_number().over(Window.partitionBy("block").orderBy(F.desc("first")))
    chosen = chosen.select("block", F.col("component").alias("own"), "first", place.alias("at")).where(F.col("at") <= REPRESENTATIVES)
    asked = placed.alias("x").join(chosen, "block").where(f"own <> component and {_near('first', 'x', apart)}")
    return asked.selectExpr(*_pair("first.node", "x.node")).distinct()


def _all_texts(found: DataFrame, documents: DataFrame, parts: DataFrame) -> DataFrame:
    """(node, text, component) of every node; one that links with none so far is its own component."""
    texts = line_texts(documents, found.where("size is not null").select("node").distinct())
    texts = texts.join(parts.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    return texts.select("node", "text", F.coalesce("component", "node").alias("component"))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Every step is written, so none needs the shuffle files of one before: they would add up on the executors' disks."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def fuzzy_groups(
    documents: DataFrame, apart: int = APART, run: int = RUN, blocks: int = BLOCKS
) -> tuple[DataFrame, DataFrame]:
    """The lines' occurrences, and (node, component) of the nodes that link with another."""
    with _shuffles_dropped(documents.sparkSession):
        return _fuzzy_groups(documents, apart, run, blocks)


def _fuzzy_groups(documents: DataFrame, apart: int, run: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    found = written(occurrences(documents, run, blocks), "lines")
    met = found.where("blocks is not null").select(F.explode("blocks").alias("block"), "node", "bits", "size")
    met = met.repartition("block").distinct().selectExpr(
        "*",
        "min(struct(node, bits, size)) over (partition by block) as first",
        "max(node) over (partition by block) as last",
    )
    met = written(met.where("first.node <> last").drop("last"), "met")
    star = met.alias("met").where(f"first.node <> node and {_near('first', 'met', apart)}")
    asked = written(star.selectExpr(*_pair("first.node", "met.node")).distinct(), "asked")
    met = met.drop("first")

    links = verified(asked, documents)
    parts = components(links)
    for number in range(ROUNDS):
        placed = written(_placed(met, parts), "open")
        more = written(_asked(placed, number, apart).join(asked, ["a", "b"], "left_anti"), "asked")
        if more.isEmpty():
            break
        asked = asked.union(more)
        links = links.union(verified(more, documents))
        parts = components(links)
    # Blocks and SimHashes only say which pairs are asked first. No link is left out: the rest is compared as well.
    texts = written(_all_texts(found, documents, parts), "texts", "zstd")
    return found, components(links.union(written(edit_links(texts, SIMILAR), "links")))


def dropped_lines(documents: DataFrame, apart: int = APART, run: int = RUN, blocks: int = BLOCKS) -> DataFrame:
    """(row, doc_id, n_lines, dropped) of every row of documents (doc_id bigint, text string).

    `dropped` are the numbers, from 0 on and ascending, of the lines of which an earlier one stays; `row` tells apart rows with the same id.
    """
    found, parts = fuzzy_groups(documents.select("doc_id", "text"), apart, run, blocks)
    place = F.struct("doc_id", "row", "line")
    nodes = found.where("node is not null").groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    nodes = nodes.join(parts.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").drop("_node")
    linked = nodes.where("component is not null").groupBy("component").agg(F.min("first").alias("kept"))
    nodes = nodes.join(linked.withColumnRenamed("component", "_of"), F.col("component") == F.col("_of"), "left")
    nodes = nodes.select(F.col("node").alias("_node"), F.coalesce("kept", "first").alias("kept"), "times", "component")
    # A node that occurs once and links with none keeps its line.
    nodes = nodes.where("times > 1 or component is not null").select("_node", "kept")
    lines = found.join(nodes, F.col("node") == F.col("_node"), "left")
    gone = F.when(F.col("kept").isNotNull() & (F.col("kept") != place), F.col("line"))
    return lines.groupBy("row", "doc_id").agg(F.count("*").alias("n_lines"), F.sort_array(F.collect_list(gone)).alias("dropped"))


def without_lines(documents: DataFrame, apart: int = APART, run: int = RUN, blocks: int = BLOCKS) -> DataFrame:
    """Documents with unique ids, without the lines that an earlier one stands for; other columns stay as they are."""
    dropped = dropped_lines(documents, apart, run, blocks).where("size(dropped) > 0").select(F.col("doc_id").alias("_id"), "dropped")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("_dropped"), i))
    joined = documents.join(dropped.withColumnRenamed("dropped", "_dropped"), F.col("doc_id") == F.col("_id"), "left")
    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*documents.columns)
