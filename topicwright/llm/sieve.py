"""A set of hashes in a fixed number of bits, to leave out early most rows that a later join would leave out anyway."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sieve has two to this power bits, 4 MB on every executor, whatever it holds; a fuller one only lets more rows through.
SIEVE_BITS = 25


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def sieve(nodes: DataFrame) -> np.ndarray:
    """Of the 64-bit hashes in the only column: tasks set the bits, Spark puts them together."""

    def run(batches):
        for batch in batches:
            place = _places(batch.column(0).to_numpy())
            word, at = np.unique(place >> 6, return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, at, np.uint64(1) << (place & 63).astype(np.uint64))
            yield pa.record_batch([pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"])

    made = nodes.mapInArrow(run, "word bigint, bits bigint")
    rows = made.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def passes(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the sieve; all that are in it are."""
    place = _places(hashes)
    return (held[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)) == 1
