"""Language identification by fusing what a text, its markup, its address and its host say.

Each row of pages or documents gets one log-probability for each language, summed from four pieces of evidence:

* the text, by its overlapping byte trigrams under a model counted over all labelled texts (mean log-likelihood, times the
  number of trigrams up to SAY, so that a long text is sure but not beyond all other evidence);
* the language that the markup declares, as often as pages that declare it have that language by their text;
* the last label of the host, the same way;
* the host: shares of languages by text among its other rows, smoothed towards those of its domain (last two labels), and
  those towards all rows.

The counts of the last three are grouped aggregations of the languages that the texts alone suggest; a row's own text is taken out
again. A document has no markup and no address; its source stands for its host.

Null or empty texts have no trigrams, and null hosts, declarations and suffixes say nothing; a row without any evidence
gets the most frequent language. Ties go to the language first by name. Without labelled texts there is no language: `language` is null and
the probability 0. Repeated rows count as rows of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.llm.shared import written
from topicwright.llm.text_arrays import LOWER, Texts, slices

#: Trigrams are hashed to so many classes.
CLASSES = 1 << 15
#: Languages that are counted in one table. All are learnt; a task holds TABLES such tables at most before it hands them on.
BLOCK = 64
TABLES = 4
#: Trigrams that count as independent.
SAY = 40
#: Rows that a level of the hosts' prior weighs as much as what is above it.
SMOOTH = 4.0

TAG = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b"
MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;"


def trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The class of each trigram and its text; bytes other than letters count as one space."""
    data = LOWER[texts.data]
    data = np.where((data >= 97) & (data <= 122) | (data >= 128), data, np.uint8(32)).astype(np.int64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = ((data[:-2] * 961 + data[1:-1]) * 961 + data[2:]) * 40503
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    inside = (owner[:-2] == owner[2:]) & ((data[:-2] != 32) | (data[1:-1] != 32))
    return (mixed[inside] >> 4) % CLASSES, owner[:-2][inside]


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray
    prior: np.ndarray

    def evidence(self, texts: Texts) -> np.ndarray:
        """For each text, what it says of each language."""
        grams, owner = trigrams(texts)
        result = np.zeros((len(texts), len(self.languages)))
        number = np.bincount(owner, minlength=len(texts))
        for i in range(len(self.languages)):
            result[:, i] = np.bincount(owner, self.likelihood[i][grams], minlength=len(texts))
        return result / np.maximum(number, 1)[:, None] * np.minimum(number, SAY)[:, None]


def learn(documents: DataFrame) -> Model:
    """From all documents (text string, lang string) with a language."""
    documents = documents.select("text", "lang").where("lang is not null and text is not null")
    rows = documents.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(r.lang for r in rows)
    index = {x: i for i, x in enumerate(languages)}

    def run(batches):
        tables = {}

        def handed_on():
            for block, total in tables.items():
                held = np.flatnonzero(total)
                yield pa.record_batch([pa.array(held + block * BLOCK * CLASSES), pa.array(total[held])], ["cell", "n"])
            tables.clear()

        for batch in batches:
            for part, texts in slices(batch, "text"):
                grams, owner = trigrams(texts)
                of = np.array([index[x] for x in part.column("lang").to_pylist()], np.int64)
                for block in np.unique(of // BLOCK).tolist():
                    if block not in tables and len(tables) == TABLES:
                        yield from handed_on()
                    mine = (of // BLOCK == block)[owner]
                    size = min(BLOCK, len(languages) - block * BLOCK) * CLASSES
                    cells = (of[owner[mine]] - block * BLOCK) * CLASSES + grams[mine]
                    tables[block] = tables.get(block, 0) + np.bincount(cells, minlength=size)
        yield from handed_on()

    counted = documents.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(languages) * CLASSES)
    total[counted["cell"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    total = total.reshape(len(languages), CLASSES) + 0.5
    number = dict(map(tuple, rows))
    prior = np.array([number[x] for x in languages], np.float64)
    return Model(languages, np.log(total / total.sum(1, keepdims=True)), np.log(prior / max(prior.sum(), 1)))


def rows_of(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(kind, doc_id, page_id, text, declared, host, domain, suffix) of both tables."""
    host = F.lower(F.nullif(F.regexp_extract("url", r"^(?s:.*?)://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    labels = F.split(host, r"\.")
    html = F.coalesce("html", F.lit(""))
    return documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("page_id"), "text",
        F.lit(None).cast("string").alias("declared"), F.concat(F.lit("source:"), F.col("source")).alias("host"),
        F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("suffix"),
    ).union(pages.select(
        F.lit("page"), F.lit(None).cast("bigint"), F.col("page_id").cast("bigint"), F.regexp_replace(html, MARKUP, " "),
        F.lower(F.nullif(F.regexp_extract(html, TAG, 1), F.lit(""))), host,
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."), F.element_at(labels, -1),
    ))


def with_text_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Rows without their text, with `says`, an array of what it says of each language, and `by_text`, the language it suggests."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    others = [c for c in rows.columns if c != "text"]
    kind = rows.select(*others, F.array(F.lit(0.0)).alias("says"), F.lit(0).alias("by_text")).schema

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                says = shared.value.evidence(texts)
                by_text = np.where(np.diff(texts.offsets) > 2, (says + shared.value.prior).argmax(1), -1).astype(np.int32)
                width = says.shape[1]
                arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(says) + 1, dtype=np.int32) * width), pa.array(says.ravel()))
                yield pa.record_batch([*(part.column(c) for c in others), arrays, pa.array(by_text)], [*others, "says", "by_text"])

    return rows.mapInArrow(run, kind)


def shares(rows: DataFrame, by: str, width: int) -> DataFrame:
    """(key, counts): for each value of a column, how many rows suggest each language."""
    each = rows.where(f"{by} is not null and by_text >= 0").groupBy(F.col(by).alias("key"), "by_text").agg(F.count("*").alias("n"))
    counts = F.map_from_entries(F.collect_list(F.struct("by_text", "n")))
    every = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.element_at(F.col("counts"), i), F.lit(0)))
    return each.groupBy("key").agg(counts.alias("counts")).select("key", every.alias("counts"))


def identify(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(kind, doc_id, page_id, language, probability, by_text) of every row of documents and of pages.

    Of documents (doc_id bigint, text string, lang string, source string), whose `lang` is only learnt from, and pages (page_id bigint,
    url string, html string). `by_text` is what the text alone suggests.
    """
    model = learn(documents)
    width = len(model.languages)
    if not width:
        rows = rows_of(documents, pages)
        return rows.selectExpr("kind", "doc_id", "page_id", "cast(null as string) as language", "0.0D as probability", "cast(null as string) as by_text")
    rows = written(with_text_evidence(rows_of(documents, pages), model), "evidence")
    # The language that a code declares, by what texts of such pages are, and the same for suffixes.
    for name in ("declared", "suffix", "host", "domain"):
        found = shares(rows, name, width).select(F.col("key").alias(f"_{name}"), F.col("counts").alias(f"{name}_counts"))
        rows = rows.join(found, F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    # Arrays of all languages, not a column for each, so that the plan doesn't grow with their number.
    top = F.array(*map(F.lit, np.exp(model.prior).tolist()))

    def smoothed(name: str, above: Column) -> Column:
        counts = F.col(f"{name}_counts")
        mine = F.transform(counts, lambda n, i: n - F.when(F.col("by_text") == i, 1).otherwise(0))
        number = F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, x: n + x) - F.when(F.col("by_text") >= 0, 1).otherwise(0)
        return F.when(counts.isNull(), above).otherwise(F.zip_with(mine, above, lambda m, a: (m + SMOOTH * a) / (number + SMOOTH)))

    rows = rows.withColumn("domain_share", smoothed("domain", top))
    rows = rows.withColumn("host_share", smoothed("host", F.col("domain_share")))
    for name in ("declared", "suffix"):
        rows = rows.withColumn(f"{name}_share", smoothed(name, top))
    # A declaration or suffix says of a language how much likelier it is there than among all rows.
    score = F.zip_with("says", "host_share", lambda x, y: x + F.log(y))
    for name in ("declared", "suffix"):
        score = F.zip_with(score, F.zip_with(f"{name}_share", top, lambda x, y: F.log(x / y)), lambda x, y: x + y)
    rows = rows.withColumn("score", score).withColumn("most", F.array_max("score"))
    names = F.array(*map(F.lit, model.languages))
    odds = F.aggregate("score", F.lit(0.0), lambda n, x: n + F.exp(x - F.col("most")))
    best = F.array_position("score", F.col("most")).cast("int")
    return rows.select(
        "kind", "doc_id", "page_id", F.element_at(names, best).alias("language"), (F.lit(1.0) / odds).alias("probability"),
        F.when(F.col("by_text") >= 0, F.element_at(names, F.col("by_text") + 1)).alias("by_text"),
    )
