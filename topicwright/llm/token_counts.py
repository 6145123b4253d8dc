"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A rollup is a folder. Each batch of changes is summed up to signed deltas of documents and tokens, one row for each group that it
touches, and written to a folder of its own. Spark's commit marker makes the batch count, all at once; a batch that was
committed before is left alone, and one that broke off is written anew. Totals are the sums over committed batches, so neither order nor
repetition of batches matters, and no change ever reads the documents again.

An insert adds a document and its tokens; a delete takes them away again; a revision takes away the count before, under the group
before, and adds the new one. Tokenizer versions are groups of their own, so a new version is counted beside the old one.

Null or empty texts are documents of 0 tokens. Null sources and languages are groups of their own. Groups without any document
left go. Repeated rows of a batch count each.
"""

from __future__ import annotations

import base64
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.llm.text_arrays import slices, texts_of

# Fixed value: the pattern that cuts texts before the merges of rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A rank file goes to every executor, so it may have so many bytes at most.
MOST_BYTES = 32 << 20
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
#: The same matches, begun only where a run of its characters begins or the last match ended, so that a long run is read once.
EMAIL_ONCE = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
GROUP = ["source", "lang", "version"]


@cache
def encoding(ranks: bytes):
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def rank_file(path: str) -> bytes:
    ranks = Path(path).read_bytes()
    if len(ranks) > MOST_BYTES:
        raise ValueError(f"{path} has more than {MOST_BYTES} bytes")
    return ranks


def counted(documents: DataFrame, tokenizers: dict[str, bytes | None]) -> DataFrame:
    """(doc_id, source, lang, version, tokens, redacted): each document's tokens, and those without e-mail addresses.

    `tokenizers` maps versions to the content of a rank file, or to None for words between white space.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tokenizers)

    def tokens(texts: list[str], column: pa.Array, ranks: bytes | None) -> np.ndarray:
        if ranks is None:
            of = texts_of(column)
            return np.bincount(of.words()[2], minlength=len(of))
        encode = encoding(ranks).encode_ordinary
        return np.array([len(encode(x)) for x in texts], np.int64)

    def run(batches):
        for batch in batches:
            for rows, _ in slices(batch, "text"):
                full, short = rows.column("text").fill_null(""), rows.column("short")
                other = np.flatnonzero(short.is_valid().to_numpy(zero_copy_only=False))
                changed = short.take(pa.array(other))
                for version, ranks in shared.value.items():
                    before = tokens(full.to_pylist(), full, ranks)
                    after = before.copy()
                    if len(other):
                        after[other] = tokens(changed.to_pylist(), changed, ranks)
                    columns = [*(rows.column(c) for c in ("doc_id", "source", "lang")), pa.array([version] * len(before)), pa.array(before), pa.array(after)]
                    yield pa.record_batch(columns, ["doc_id", *GROUP, "tokens", "redacted"])

    short = F.when(F.col("text").rlike(EMAIL_ONCE), F.regexp_replace("text", EMAIL_ONCE, ""))
    kind = "doc_id bigint, source string, lang string, version string, tokens bigint, redacted bigint"
    return documents.select("doc_id", "source", "lang", "text", short.alias("short")).mapInArrow(run, kind)


def inserts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return rows.select(*GROUP, F.lit(1).alias("documents"), F.col(tokens).alias("tokens"))


def deletes(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return rows.select(*GROUP, F.lit(-1).alias("documents"), (-F.col(tokens)).alias("tokens"))


def revisions(rows: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose counts change in place; for a change of group, delete and insert."""
    return rows.select(*GROUP, F.lit(0).alias("documents"), (F.col(after) - F.col(before)).alias("tokens"))


class Rollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows (source, lang, version, documents, tokens); false if it was there before."""
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"not a name of a batch: {batch!r}")
        folder = f"{self.path}/batch={batch}"
        if self._exists(f"{folder}/_SUCCESS"):
            return False
        sums = changes.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        sums.where("documents <> 0 or tokens <> 0").write.mode("overwrite").parquet(folder)
        return True

    def batches(self) -> list[str]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        found = [f.getPath().toString() for f in files.listStatus(where)]
        return sorted(x for x in found if "/batch=" in x and self._exists(f"{x}/_SUCCESS"))

    def totals(self) -> DataFrame:
        """(source, lang, version, documents, tokens) over all committed batches."""
        kind = "source string, lang string, version string, documents bigint, tokens bigint"
        found = self.batches()
        deltas = self.spark.read.schema(kind).parquet(*found) if found else self.spark.createDataFrame([], kind)
        sums = deltas.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")
