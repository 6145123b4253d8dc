"""From raw documents to a training mix, in stages.

Each stage gets the rows that the one before it left (documents at first) and returns those that stay, with the columns
of documents; the last adds how much of each document the mix takes. A stage decides on its own input only. Nulls, empty
texts, ties, repeated rows, empty tables and other columns are treated as each operator says of itself:

* a text without features gets the share of good labels as its score, so an empty one stays when most labels are good;
* of equal texts (A-Z in lower case) the row with the largest id stays; null counts as empty;
* of texts that link by word 5-grams the row with the smallest id stays, other texts of that id in the group go; null ids stay, empty texts never link;
* a document that holds a passage of a benchmark item goes; null texts hold none;
* null sources are one source; documents of which the mix takes no word (empty ones among them) go.

Other columns may have any name: they have names of their own within a stage. Only the mix's figures replace columns of the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.llm.decontaminate import without_leaks
from topicwright.llm.digest_dedup import first_half, without_copies
from topicwright.llm.jaccard_join import without_near_copies
from topicwright.llm.mixing import mix_documents
from topicwright.llm.quality import fit, held_out, score
from topicwright.llm.shared import importable, table, written

#: The columns of documents that stages look at.
NEEDED = ("doc_id", "text", "source")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def any_names(stage: Stage) -> Stage:
    """The stage, with names of their own for all columns that it doesn't look at, so that none clashes with its own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tag = uuid.uuid4().hex
        made = [name if name in NEEDED else f"c{i}_{tag}" for i, name in enumerate(docs.columns)]
        names = dict(zip(made, docs.columns))
        left = stage(spark, docs.toDF(*made), sf_dir)
        added = {c.lower() for c in left.columns if c not in names}
        kept = [c for c in left.columns if c not in names or names[c].lower() not in added]
        return left.select(*kept).toDF(*(names.get(c, c) for c in kept))

    return run_stage


@any_names
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that labelled neighbours vote for with 0.7 at least; held-out labels are not used."""
    importable(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return score(docs, model).where("score >= 0.7").select(*docs.columns)


@any_names
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    importable(spark)
    return without_copies(docs, first_half(docs))


@any_names
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams."""
    importable(spark)
    return without_near_copies(docs, words=5, share=80)


@any_names
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


@any_names
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, and how many words it takes of each: 150% of all words, a source twice at most."""
    mixed = mix_documents(docs, None, share=1.5, epochs=2.0, seed=17, whole_rows=True)
    return mixed.where("taken > 0")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: The quality stage learns from a table; SQL can't say what it decides.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
