"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwright.llm import toxicity
from topicwright.llm.decontaminate import leaks
from topicwright.llm.digest_dedup import exact_groups, first_half
from topicwright.llm.jaccard_join import jaccard_components
from topicwright.llm.language import identify
from topicwright.llm.licenses import scan
from topicwright.llm.line_dedup import dropped_lines
from topicwright.llm.mixing import mix_documents
from topicwright.llm.quality import fit, held_out, score
from topicwright.llm.runs import periodic_runs
from topicwright.llm.search import search
from topicwright.llm.shared import folder, table, written
from topicwright.llm.token_counts import Rollup, counted, deletes, inserts, rank_file, revisions
from topicwright.llm.url_filter import judge

#: A public vocabulary; the setting `topicwright.tokenizer.ranks` names another one.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Rules of a host and the beginning of a path.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, redact e-mail addresses, withdraw toxic documents, and commit the redaction once more, in vain."""
    ranks = rank_file(spark.conf.get("topicwright.tokenizer.ranks", TOKENIZER))
    documents = table(spark, sf_dir, "documents")
    rows = written(counted(documents, {"byte_bpe_50k": ranks, "words": None}), "tokens")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    redacted = revisions(rows.where("tokens <> redacted"), "tokens", "redacted")
    rollup = Rollup(spark, folder(spark))
    rollup.commit("load", inserts(rows))
    rollup.commit("redact", redacted)
    rollup.commit("withdraw", deletes(rows.join(toxic, "doc_id", "left_semi"), "redacted"))
    rollup.commit("redact", redacted)
    return rollup.totals()


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_documents(documents, None, share=1.5, epochs=2.0, seed=17)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    groups = exact_groups(documents, first_half(documents))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return groups.select("doc_id", "keep_id", "group_size", "kept", sha)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=5, share=80)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "dropped")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = fit(documents, labels.select("doc_id", F.col("quality").alias("label")))
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return score(documents, model).select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit(documents, labels.select("doc_id", F.col("toxic").alias("label")))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    held = toxicity.held_out().alias("held_out")
    return toxicity.score(documents, model).select("doc_id", held, "score", predicted.alias("predicted"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    better = "x.length * best.period > best.length * x.period"
    best = F.expr(f"aggregate(runs, get(runs, 0), (best, x) -> if({better}, x, best))")
    lines = "transform(runs, x -> concat_ws(',', x.start, x.length, x.period) || '\n')"
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.expr(lines)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(documents: DataFrame) -> DataFrame:
    """Documents of which one in ten, by its id, has its words repeated from one of them on."""
    picked = documents.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id as string) as binary)) as h")
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit("[^\x20\x09-\x0D]+"), F.lit(0)))
    picked = picked.withColumn("words", words).selectExpr("*", "size(words) as n", "h div 10 as g")
    picked = picked.selectExpr("*", "g % nullif(n, 0) as a").selectExpr("*", "1 + (n - a) div (3 + g % 8) as p")
    place = "cast(if(i < a, i, a + (i - a) % p) as int)"
    again = f"array_join(transform(sequence(0, n - 1), i -> words[{place}]), ' ')"
    return picked.selectExpr("doc_id", f"if(n > 0, {again}, text) as text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_url_filter,
        op3_license_scan,
        op4_language_id,
        op5_benchmark_decontamination,
        op6_mix_sources,
        op7_exact_dedup,
        op8_ngram_jaccard_join,
        op9_line_dedup,
        op10_quality_classifier,
        op11_lexical_search,
        op12_toxicity,
        op13_periodic_runs,
    )
}
