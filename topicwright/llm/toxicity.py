"""Toxicity: logistic regression over hashed words, word n-grams and skip-grams, learnt with FTRL-proximal.

A text's features are the distinct places, among PLACES, of its words, of the beginnings of its longer words (so that inflected and
compounded forms count together), of pairs of neighbouring words, and of pairs with one or two words left out
between them. Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased.

Learning goes through labelled rows one after another, in the order of a seeded hash of their ids. Each feature keeps two sums, `z` and `n`: it
has its own learning rate, which falls with the root of its summed squared gradients `n`, and it weighs nothing until `z`
exceeds the L1 penalty, so that of a million places a few hundred get a weight. The features of VISITS rows at most are made in parallel
and pass through one task, which holds one row and the two sums, whatever the rows' sizes; fewer rows pass more than once, PASSES times at most. The
weights that are not zero go to all executors (8 bytes each, 8 MB at most), and every whole text is scored in one pass
without a shuffle.

Null and empty texts have no feature: their score is that of the base rate. Labels that are null are left out, of several labels of a
document the greatest counts. Without labels every score is 0. Repeated rows get one row of output each; other columns than
`doc_id` and `text` are carried on and never looked at, except that one named `score` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.llm.shared import written
from topicwright.llm.terms import labelled_texts, term_spans
from topicwright.llm.text_arrays import Texts, mix, slices

#: Features are hashed to so many places; the first half is for words and their beginnings.
PLACES = 1 << 20
#: Lengths in bytes of the beginnings of longer words.
BEGINNINGS = (4, 5, 6, 7)
#: Distances of the two words of a pair: neighbours, and with one or two words left out.
DISTANCES = (1, 2, 3)
#: Labelled rows that are learnt from, each pass counted.
VISITS = 8192
PASSES = 4
#: Learning rate, its smoothing, and the penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 3.0, 1.0


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The place of each feature, with repeats, and the text that has it."""
    lowered = texts.lowered()
    starts, ends, owner = term_spans(lowered)
    words = lowered.hashes(starts, ends)
    half = np.uint64(PLACES // 2)
    places, owners = [words % half], [owner]
    for length in BEGINNINGS:
        longer = ends - starts > length
        begun = lowered.hashes(starts[longer], starts[longer] + length)
        places.append(mix(begun + np.uint64(length)) % half)
        owners.append(owner[longer])
    for distance in DISTANCES:
        same = owner[distance:] == owner[:-distance]
        pair = words[:-distance] * np.uint64(2 * distance + 1) + mix(words[distance:])
        places.append(half + mix(pair[same]) % half)
        owners.append(owner[distance:][same])
    return np.concatenate(places).astype(np.int64), np.concatenate(owners)


def distinct(places: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(owners * PLACES + places)
    return keys % PLACES, keys // PLACES


class Learner:
    """FTRL-proximal with the sums of all places; the last place is the bias, which has no penalty."""

    def __init__(self):
        self.z, self.n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        penalty = np.full(len(z), L1)
        penalty[-1] = 0.0
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= penalty, 0.0, (np.sign(z) * penalty - z) / rate)

    def learn(self, places: np.ndarray, label: float) -> None:
        at = np.append(places, PLACES)
        weights = self.weights(at)
        gradient = float(chance(weights.sum())) - label
        before = self.n[at]
        after = before + gradient * gradient
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * weights
        self.n[at] = after


def chance(total):
    return 1.0 / (1.0 + np.exp(-np.clip(total, -40.0, 40.0)))


@dataclass
class Weights:
    """The places that weigh something, ascending, what they weigh, and the bias; None for the bias if nothing was learnt."""

    places: np.ndarray
    weights: np.ndarray
    bias: float | None

    @cached_property
    def table(self) -> np.ndarray:
        table = np.zeros(PLACES, np.float32)
        table[self.places] = self.weights
        return table

    def scores(self, texts: Texts) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(texts))
        places, owners = features(texts)
        weighs = self.table[places] != 0
        places, owners = distinct(places[weighs], owners[weighs])
        return chance(self.bias + np.bincount(owners, self.table[places].astype(np.float64), len(texts)))


def fit(documents: DataFrame, labels: DataFrame, visits: int = VISITS) -> Weights:
    """Weights learnt from labels (doc_id, label 0 or 1) of documents (doc_id, text)."""

    def featured(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                places, owners = distinct(*features(texts))
                cuts = np.searchsorted(owners, np.arange(len(texts) + 1))
                packed = [places[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                columns = [rows.column("doc_id"), rows.column("label"), rows.column("place"), pa.array(packed, pa.binary())]
                yield pa.record_batch(columns, ["doc_id", "label", "place", "features"])

    def learnt(batches):
        learner, rows = Learner(), 0
        for batch in batches:
            for label, packed in zip(batch.column("label").to_pylist(), batch.column("features")):
                learner.learn(np.frombuffer(packed.as_py(), np.int32).astype(np.int64), float(label))
                rows += 1
        weights = learner.weights(np.arange(PLACES + 1))
        places = np.flatnonzero(weights[:-1])
        if rows:
            places = np.append(places, PLACES)
        yield pa.record_batch([pa.array(places), pa.array(weights[places])], ["place", "weight"])

    taken = labelled_texts(documents, labels, visits)
    made = taken.mapInArrow(featured, "doc_id bigint, label int, place bigint, features binary")
    made = written(made, "features")
    passes = max(1, min(PASSES, visits // max(1, made.count())))
    again = made.select(F.explode(F.array(*map(F.lit, range(passes)))).alias("pass"), "label", "place", "doc_id", "features")
    rows = again.coalesce(1).sortWithinPartitions("pass", "place", "doc_id").select("label", "features")
    found = sorted(map(tuple, rows.mapInArrow(learnt, "place bigint, weight double").collect()))
    bias = found.pop()[1] if found else None
    return Weights(np.array([p for p, _ in found], np.int64), np.array([w for _, w in found], np.float32), bias)


def score(documents: DataFrame, model: Weights) -> DataFrame:
    """Every row of documents with its score in a column `score`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [field for field in documents.schema if field.name.lower() != "score"]
    documents = documents.select(*(F.col("`" + field.name.replace("`", "``") + "`") for field in kept))
    # Columns by number on the way through Python, so that no name clashes.
    numbered = documents.toDF(*(f"c{i}" for i in range(len(kept))))
    text = f"c{[field.name for field in kept].index('text')}"
    kind = numbered.select("*", F.lit(0.0).alias("made")).schema

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, text):
                yield pa.record_batch([*rows.columns, pa.array(shared.value.scores(texts))], names=kind.names)

    return numbered.mapInArrow(run, kind).toDF(*documents.columns, "score")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
