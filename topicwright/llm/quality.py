"""Quality classifier: nearest labelled neighbours of every text in a latent-semantic space vote on its quality.

A text is a bag of hashed words, of pairs of neighbouring character classes, and of repetitions (a word or a line that is equal to
the one before). Weights are the square roots of relative counts times an inverse document frequency counted over
all texts. A bounded sample of labelled rows gives the latent space (the main axes of their weights) and, in that
space, one unit vector each, which every executor gets. Every text's cosine with all of them is a product of blocks
of matrices; the NEIGHBOURS closest ones vote with their label, weighted by a power of their cosine.

Null and empty texts have no features: no neighbour is near, and the score is the share of good labels. Labels that are
null are left out; rows that label one text differently count as the worse. Without labels, the score is 0.5. Repeated rows
get one row of output each, and other columns than `doc_id` and `text` are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.llm.text_arrays import Texts, slices

WORD_FEATURES = 512
SHAPE_CLASSES = 24
FEATURES = WORD_FEATURES + SHAPE_CLASSES * SHAPE_CLASSES + 2
#: Labelled rows that fit the space and vote: at most so many, taken in the order of a seeded hash of their ids.
LABELLED = 6000
DIMENSIONS = 64
NEIGHBOURS = 24
SHARPNESS = 8
#: Weight of the base rate, so that a text without near neighbours gets it.
BASE = 1e-3


def _classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, white space, line ends, single marks, all else."""
    marks = b".,;:!?|#*&%$-=+/<>"
    table = np.full(256, 5, np.uint8)
    table[128:] = 0
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1] = 0, 1
    table[ord("0") : ord("9") + 1] = 2
    table[[9, 11, 12, 13, 32]], table[10] = 3, 4
    for i, mark in enumerate(marks):
        table[mark] = 6 + i
    return table


CLASSES = _classes()


def counts(texts: Texts) -> np.ndarray:
    """How often each feature occurs in each text."""
    size = len(texts)
    lowered = texts.lowered()
    starts, ends, owner = lowered.words()
    words = lowered.hashes(starts, ends)
    found = np.zeros((size, FEATURES), np.float32)
    place = owner * WORD_FEATURES + (words % np.uint64(WORD_FEATURES)).astype(np.int64)
    found[:, :WORD_FEATURES] = np.bincount(place, minlength=size * WORD_FEATURES).reshape(size, -1)
    if len(texts.data) > 1:
        shape = CLASSES[texts.data].astype(np.int64)
        of = np.repeat(np.arange(size), np.diff(texts.offsets))
        inside = of[1:] == of[:-1]
        pair = (of[1:] * SHAPE_CLASSES + shape[:-1]) * SHAPE_CLASSES + shape[1:]
        pairs = np.bincount(pair[inside], minlength=size * SHAPE_CLASSES**2).reshape(size, -1)
        found[:, WORD_FEATURES:-2] = pairs
    if len(words) > 1:
        again = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        found[:, -2] = np.bincount(owner[1:][again], minlength=size)
    breaks = np.flatnonzero(texts.data == 10)
    edges = np.unique(np.concatenate([texts.offsets, breaks + 1]))
    if len(edges) > 2:
        lines = texts.hashes(edges[:-1], edges[1:])
        of = np.searchsorted(texts.offsets, edges[:-1], "right") - 1
        again = (lines[1:] == lines[:-1]) & (of[1:] == of[:-1])
        found[:, -1] = np.bincount(of[1:][again], minlength=size)
    return found


def weights(found: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Each group of features on its own scale, so that long texts and short ones compare."""
    result = np.empty_like(found)
    for low, high in ((0, WORD_FEATURES), (WORD_FEATURES, FEATURES - 2), (FEATURES - 2, FEATURES)):
        total = found[:, :high].sum(1, keepdims=True) if high == FEATURES else found[:, low:high].sum(1, keepdims=True)
        result[:, low:high] = np.sqrt(found[:, low:high] / np.maximum(total, 1))
    return result * inverse


def document_frequencies(documents: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts and how many of them have each feature, counted over all texts."""

    def run(batches):
        total, number = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for _, texts in slices(batch, "text"):
                total += (counts(texts) > 0).sum(0)
                number += len(texts)
        columns = [np.arange(-1, FEATURES), np.append(number, total)]
        yield pa.record_batch([pa.array(x) for x in columns], ["feature", "texts"])

    summed = documents.select("text").mapInArrow(run, "feature bigint, texts bigint").groupBy("feature")
    rows = dict(map(tuple, summed.agg(F.sum("texts")).collect()))
    return rows.get(-1, 0), np.array([rows.get(i, 0) for i in range(FEATURES)])


@dataclass
class Neighbours:
    """The latent space and the labelled vectors in it."""

    inverse: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def base(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def place(self, texts: Texts) -> np.ndarray:
        placed = weights(counts(texts), self.inverse) @ self.axes
        return placed / np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: Texts) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        placed, k = self.place(texts), min(NEIGHBOURS, len(self.labels))
        result = np.empty(len(texts))
        for low in range(0, len(texts), 512):
            cosines = placed[low : low + 512] @ self.vectors.T
            near = np.argpartition(cosines, -k, axis=1)[:, -k:]
            votes = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** SHARPNESS
            result[low : low + 512] = (votes * self.labels[near]).sum(1) + BASE * self.base
            result[low : low + 512] /= votes.sum(1) + BASE
        return np.clip(result, 0, 1)


def fit(documents: DataFrame, labels: DataFrame, most: int = LABELLED) -> Neighbours:
    """The space and voters from labels (doc_id, label 0 or 1) of documents (doc_id, text)."""
    number, texts_with = document_frequencies(documents)
    inverse = (np.log((1 + number) / (1 + texts_with)) + 1).astype(np.float32)
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                found = weights(counts(texts), inverse)
                packed = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.record_batch([rows.column("doc_id"), rows.column("label"), packed], ["doc_id", "label", "found"])

    # One text for each label, so that repeated rows don't exceed the bound.
    taken = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    taken = taken.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("text").alias("text"))
    rows = sorted(taken.mapInArrow(run, "doc_id bigint, label int, found binary").collect(), key=lambda r: r.doc_id)
    found = np.array([np.frombuffer(r.found, np.float32) for r in rows]).reshape(len(rows), FEATURES)
    _, axes = np.linalg.eigh((found.T @ found).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :DIMENSIONS], np.float32)
    vectors = found @ axes
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Neighbours(inverse, axes, vectors, np.array([r.label for r in rows], np.float64))


def score(documents: DataFrame, model: Neighbours) -> DataFrame:
    """Every row of documents with its score in a column `score`; its other columns stay as they are, but one of that name."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.select(*(c for c in documents.columns if c.lower() != "score"))
    columns = documents.columns
    kind = documents.select(*columns, F.lit(0.0).alias("_score")).schema

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                yield pa.record_batch([*rows.columns, pa.array(shared.value.scores(texts))], names=[*columns, "_score"])

    return documents.mapInArrow(run, kind).withColumnRenamed("_score", "score")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
