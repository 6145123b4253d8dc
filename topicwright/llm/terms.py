"""Runs of letters, digits and characters beyond ASCII in batches of text, and rows that a bounded list of labels names."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwright.llm.text_arrays import SOLID, Texts


def term_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each term, a longest run of such characters in one text, and the text that holds it."""
    solid = SOLID[texts.data]
    size = len(solid)
    edge = np.zeros(size + 1, bool)
    edge[texts.offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:size]
    closes[:-1] &= ~solid[1:] | edge[1:size]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(texts.offsets, starts, "right") - 1


def labelled_texts(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, label, text, place) of so many labelled documents at most, in the order `place` of a seeded hash of their ids.

    Of several labels of a document the greatest counts, of several texts the greatest.
    """
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    place = F.xxhash64("doc_id", F.lit(12)).alias("place")
    chosen = labels.select("doc_id", "label", place).orderBy("place", "doc_id").limit(most)
    taken = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return taken.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"), F.max("place").alias("place"))
