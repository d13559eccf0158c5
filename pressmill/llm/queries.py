"""The registered queries of this package: each applies one operator to its whole table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import pseudolikelihood
from pressmill.llm.credentials import secret_spans
from pressmill.llm.decontaminate import contaminated_words
from pressmill.llm.exact import exact_groups
from pressmill.llm.langid import classified
from pressmill.llm.licenses import PHRASE_SCORE, license_labels
from pressmill.llm.lines import dedup_lines
from pressmill.llm.negatives import hard_negatives
from pressmill.llm.packing import packed_documents
from pressmill.llm.pagetext import extract
from pressmill.llm.simhash import near_groups
from pressmill.llm.sketch import edited_fingerprints
from pressmill.llm.whitening import whitened
from pressmill.llm.words import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudolikelihood.score(docs, pseudolikelihood.learn(docs))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_labels(table(spark, sf_dir, "documents"))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("spans", lambda s: s["label"]))))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["covered"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(F.col("n_base") > 0, PHRASE_SCORE).otherwise(0.0)).alias("score"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_lm_score": op3_lm_score,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_language": op5_language,
    "op6_packing": op6_packing,
    "op7_secrets": op7_secrets,
    "op8_licenses": op8_licenses,
    "op9_main_text": op9_main_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_hard_negatives": op13_hard_negatives,
}
