"""Ranked search with max-sketches: bounds from a small sketch of each document decide which documents are scored exactly.

The index has a row for each document with at least one term: its number of terms, the hashes of its distinct terms with the
number of times each occurs, and a sketch. The sketch has CELLS to twice as many cells for each distinct term. A term is
hashed to HASHES cells, and each cell keeps the most that any of its terms has: an impact only rises with the number of times a term
occurs, so the cell keeps that number, as one byte that stands for it or for the next larger number that has a code.
The least of a term's cells then bounds its impact in the document from above; the impact itself follows once the
number and mean length of documents are known, so the index is built in one pass over the texts and serves any queries.

Queries go in blocks of bounded size, one pass over the index each. A task looks up the terms of a whole group of queries in a
batch of sketches at once; the sum of weight times bound over a query's terms bounds a document's score. It then scores
documents exactly from their stored terms, in the order of falling bounds, until the bound is below the TOP-th best score of
the query that the task has met. What is left, TOP rows a query and task at most, goes through two rounds of ranking, first within
shares of the tasks, then within the query.

Scores are whole numbers below 2**53, so sums in doubles are exact. Terms are compared by 64-bit hashes.

Null texts and texts without terms are no documents. Rows that share an id, or have no id, are documents of their own; of
equal scores the smaller id comes first, null last. Rows of queries with equal id and text count once; ids with several texts get
TOP rows for each of them. Queries without terms, or without a document that scores, get no row. Other columns
are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwright.llm.shared import written
from topicwright.llm.terms import term_spans
from topicwright.llm.text_arrays import Texts, mix, slices, texts_of

#: Cells of a sketch for each distinct term: so many to twice as many. And the cells that each term is hashed to.
CELLS = 4
HASHES = 2
LEAST_CELLS = 64
#: Documents returned for each query.
TOP = 10
#: Bytes of query texts in a block, on average, and distinct terms of queries that are looked up together.
BLOCK_BYTES = 1 << 20
GROUP_TERMS = 4096
#: Numbers in one array of looked-up bounds.
AT_ONCE = 1 << 21
#: Documents that are scored before the bound is looked at again.
STEP = 8
#: Shares of a query's candidates that are ranked before the query's.
SHARES = 64


def _codes() -> np.ndarray:
    """What each of 256 codes stands for: counts up to 160 as they are, then each an eighth more than the one before."""
    values = list(range(161))
    while len(values) < 256:
        values.append(values[-1] + values[-1] // 8)
    return np.array(values, np.int64)


CODES = _codes()


def counted_terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct terms of each text, ascending, how often each occurs, where each text begins, and terms of each."""
    lowered = texts.lowered()
    starts, ends, owner = term_spans(lowered)
    hashes = lowered.hashes(starts, ends)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(hashes)))
    begins = np.searchsorted(owner[at], np.arange(len(texts) + 1))
    return hashes[at], times, begins, np.bincount(owner, minlength=len(texts))


def _cells(hashes: np.ndarray, number: int) -> np.ndarray:
    return mix(hashes + np.uint64(number + 1))


def sketches(hashes: np.ndarray, times: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketches one after another as bytes, and where each begins."""
    distinct = np.diff(begins)
    sizes = 1 << np.ceil(np.log2(np.maximum(CELLS * distinct, LEAST_CELLS))).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    code = np.searchsorted(CODES, times)
    # Ascending, so that of the terms of one cell the one with the greatest code is written last.
    order = np.argsort(code, kind="stable")
    base, mask = np.repeat(offsets[:-1], distinct)[order], np.repeat(sizes - 1, distinct)[order].astype(np.uint64)
    cells, codes = np.zeros(offsets[-1], np.uint8), code[order].astype(np.uint8)
    for number in range(HASHES):
        place = base + (_cells(hashes[order], number) & mask).astype(np.int64)
        cells[place] = np.maximum(cells[place], codes)
    return cells, offsets


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def build_index(documents: DataFrame) -> DataFrame:
    """(doc_id, n, terms, times, sketch) of every row of documents (doc_id bigint, text string) that has a term."""

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                hashes, times, begins, n = counted_terms(texts)
                cells, offsets = sketches(hashes, times, begins)
                columns = [
                    rows.column("doc_id"),
                    pa.array(n),
                    _binaries(hashes.view(np.uint8), begins * 8),
                    _binaries(times.astype(np.uint32).view(np.uint8), begins * 4),
                    _binaries(cells, offsets),
                ]
                made = pa.record_batch(columns, ["doc_id", "n", "terms", "times", "sketch"])
                yield made.filter(pa.array(n > 0))

    kind = "doc_id bigint, n bigint, terms binary, times binary, sketch binary"
    return documents.select("doc_id", "text").mapInArrow(run, kind)


@dataclass
class Queries:
    """Queries as distinct terms with the number of times each occurs."""

    items: list
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @staticmethod
    def of(rows: list) -> Queries:
        hashes, times, begins, _ = counted_terms(texts_of(pa.array([r[1] for r in rows], pa.string())))
        held = [i for i in range(len(rows)) if begins[i] < begins[i + 1]]
        parts = [slice(begins[i], begins[i + 1]) for i in held]
        return Queries([rows[i][0] for i in held], [hashes[p] for p in parts], [times[p] for p in parts])

    @property
    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate(self.terms)) if self.terms else np.zeros(0, np.uint64)


def document_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How many documents hold each of these terms, counted over the whole index."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            hashes = texts_of(batch.column("terms")).data.view(np.uint64)
            at = np.minimum(np.searchsorted(shared.value, hashes), len(shared.value) - 1)
            total += np.bincount(at[shared.value[at] == hashes], minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["term", "documents"])

    summed = index.select("terms").mapInArrow(run, "term bigint, documents bigint").groupBy("term")
    found = np.zeros(len(vocabulary), np.int64)
    for term, documents in summed.agg(F.sum("documents")).collect():
        found[term] = documents
    return found


def term_weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64)


def length_norm(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    return 25 + (75 * n * documents) // length


def impact(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * norm)


class Group:
    """Queries that are looked up together: their terms, and the weights of each in each query."""

    def __init__(self, numbers: list[int], queries: Queries, weights: dict[int, int]):
        self.numbers = numbers
        self.terms = np.unique(np.concatenate([queries.terms[q] for q in numbers]))
        self.table = np.zeros((len(self.terms), len(numbers)))
        for column, q in enumerate(numbers):
            own = np.array([weights[t] for t in queries.terms[q].tolist()], np.int64) * queries.times[q]
            self.table[np.searchsorted(self.terms, queries.terms[q]), column] = own
        self.cells = [_cells(self.terms, number) for number in range(HASHES)]

    def bounds(self, cells: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """For sketches of one size and the impacts that their codes stand for: a bound on the score for each query."""
        mask = np.uint64(cells.shape[1] - 1)
        found = np.empty((len(cells), len(self.numbers)))
        step = max(1, AT_ONCE // max(1, len(self.terms)))
        for low in range(0, len(cells), step):
            part = cells[low : low + step]
            codes = part[:, (self.cells[0] & mask).astype(np.int64)]
            for hashed in self.cells[1:]:
                np.minimum(codes, part[:, (hashed & mask).astype(np.int64)], out=codes)
            flat = codes + (np.arange(len(part)) * 256)[:, None]
            found[low : low + step] = impacts[low : low + step].ravel()[flat] @ self.table
        return found


def grouped(queries: Queries, weights: dict[int, int]) -> list[Group]:
    groups, numbers, terms = [], [], 0
    for q, own in enumerate(queries.terms):
        if numbers and terms + len(own) > GROUP_TERMS:
            groups.append(Group(numbers, queries, weights))
            numbers, terms = [], 0
        numbers.append(q)
        terms += len(own)
    return [*groups, Group(numbers, queries, weights)] if numbers else groups


class _Searcher:
    """The best documents that a task has met, for each query."""

    def __init__(self, groups: list[Group], documents: int, length: int, top: int):
        self.groups, self.documents, self.length, self.top = groups, documents, length, top
        # (score, minus the id, id): the worst that is kept comes first.
        self.best: dict[int, list[tuple]] = {q: [] for group in groups for q in group.numbers}

    def look(self, batch: pa.RecordBatch) -> None:
        ids, n = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy()
        norm = length_norm(n, self.documents, self.length)
        sketch, terms, times = (texts_of(batch.column(x)) for x in ("sketch", "terms", "times"))
        sizes = np.diff(sketch.offsets)
        for size in np.unique(sizes).tolist():
            of_size = np.flatnonzero(sizes == size)
            step = max(1, AT_ONCE // size)
            for low in range(0, len(of_size), step):
                rows = of_size[low : low + step]
                cells = sketch.data[sketch.offsets[rows][:, None] + np.arange(size)]
                impacts = impact(CODES[None, :], norm[rows][:, None]).astype(np.float64)
                for group in self.groups:
                    bounds = group.bounds(cells, impacts)
                    for column, q in enumerate(group.numbers):
                        self._descend(q, group, column, bounds[:, column], rows, ids, norm, terms, times)

    def _descend(self, q, group, column, bounds, rows, ids, norm, terms, times) -> None:
        best = self.best[q]
        least = best[0][0] if len(best) == self.top else 1
        open_ = np.flatnonzero(bounds >= least)
        if not len(open_):
            return
        own = np.flatnonzero(group.table[:, column])
        asked, weights = group.terms[own], group.table[own, column].astype(np.int64)
        order = open_[np.argsort(-bounds[open_], kind="stable")]
        for low in range(0, len(order), STEP):
            if bounds[order[low]] < (best[0][0] if len(best) == self.top else 1):
                return
            for i in order[low : low + STEP].tolist():
                row = rows[i]
                held = terms.data[terms.offsets[row] : terms.offsets[row + 1]].view(np.uint64)
                at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
                there = held[at] == asked
                number = times.data[times.offsets[row] : times.offsets[row + 1]].view(np.uint32)[at[there]].astype(np.int64)
                score = int((weights[there] * impact(number, norm[row])).sum())
                if score > 0:
                    self._keep(best, score, ids[row])

    def _keep(self, best: list[tuple], score: int, doc_id: int | None) -> None:
        entry = (score, -(1 << 70) if doc_id is None else -doc_id)
        if len(best) < self.top:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of bytes, though Spark counts them in rows."""
    for batch in batches:
        yield from (rows for rows, _ in slices(batch, "sketch"))


def search(documents: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents (doc_id, text) for each of the queries (item_id, text)."""
    spark = documents.sparkSession
    index = written(build_index(documents), "index")
    number, length = index.agg(F.count("*"), F.sum("n")).first()
    items = queries.select("item_id", "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    items = written(items.withColumn("block", block), "queries")
    kind, found = items.schema["item_id"].dataType.simpleString(), None
    for number_of_block in range(blocks if number else 0):
        rows = items.where(F.col("block") == number_of_block).orderBy("item_id", "text").select("item_id", "text").collect()
        part = _search_block(spark, index, Queries.of([tuple(r) for r in rows]), kind, number, length, top)
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return found


def _search_block(
    spark, index: DataFrame, queries: Queries, kind: str, documents: int, length: int, top: int
) -> DataFrame | None:
    if not queries.items:
        return None
    vocabulary = queries.vocabulary
    weights = dict(zip(vocabulary.tolist(), term_weights(documents, document_counts(index, vocabulary)).tolist()))
    shared = spark.sparkContext.broadcast(grouped(queries, weights))

    def run(batches):
        searcher = _Searcher(shared.value, documents, length, top)
        for batch in _aligned(batches):
            searcher.look(batch)
        rows = [(q, None if i == -(1 << 70) else -i, score) for q, best in searcher.best.items() for score, i in best]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        yield pa.record_batch(columns, ["query", "doc_id", "score"])

    met = index.select("doc_id", "n", "terms", "times", "sketch").mapInArrow(run, "query bigint, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    met = met.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
    for by in (["query", "share"], ["query"]):
        met = met.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(queries.items)), f"query bigint, item_id {kind}")
    return met.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
