"""Documents to packed training text: language, repeated lines, near duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) with the columns of documents and works on all rows that its predecessor kept. Other
columns are kept as they are, whatever their names. Rows are told apart by themselves, never by doc_id, so null and repeated
ids are safe. What a stage writes on its way is its own and is deleted before it returns, but for what its result reads.

Defined results: stages give no rows for none; a null text is rejected by the language stage and counts as empty in the
others; repeated rows are near duplicates of each other, so one of them stays.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import langid
from pressmill.llm.decontaminate import contaminated_words
from pressmill.llm.lines import dedup_lines
from pressmill.llm.packing import packed_documents
from pressmill.llm.simhash import copy_groups
from pressmill.llm.words import fresh, small_batches, whole_row
from pressmill.session import materialize, recorded_scratch, remove_scratch, scratch_path

#: a document whose main language has a smaller share is a mixture of many and is rejected, as is one of no language or one
#: whose trigrams are less likely in its languages than by chance
LEAST_SHARE = 0.3


def _decided(spark: SparkSession, label: str, decide: Callable[[], DataFrame]) -> DataFrame:
    """The written rows of ``decide``; all else it wrote is deleted."""
    path = scratch_path(spark, label)
    with recorded_scratch() as spent:
        found = decide()
        found.write.parquet(path)
    remove_scratch(spark, spent)
    return spark.read.schema(found.schema).parquet(path)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised main language."""
    small_batches(spark)
    model = langid.learn(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))))
    found = langid.judged(docs.select(whole_row(docs).alias("doc"), "text"), model, "doc")
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE) & (F.col("sense") >= 0)).select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share; n_chars follows the text."""
    small_batches(spark)
    counts = fresh(docs, "lines_before"), fresh(docs, "lines_dropped")
    return dedup_lines(docs, counts=counts).drop(*counts).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies: fingerprints within the radius, or five-word
    shingles of a similarity of 0.8 or more."""
    small_batches(spark)
    row = fresh(docs, "pipeline_row")
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "stage")

    def left_out() -> DataFrame:
        groups = materialize(copy_groups(rows, row).join(rows.select(row, "doc_id"), row), "groups")
        first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row).alias("row")))
        stays = groups.groupBy("group").agg(first["row"].alias(row)).select(row)
        return groups.select(row).join(stays, row, "left_anti")

    return rows.join(_decided(spark, "copies", left_out), row, "left_anti").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage; equal texts are told by their hash."""
    small_batches(spark)
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))

    def found() -> DataFrame:
        hits = contaminated_words(keyed.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key)
        return hits.where(F.size("hits") > 0).select(key).distinct()

    return keyed.join(_decided(spark, "dirty", found), key, "left_anti").drop(key)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bins."""
    return packed_documents(docs.select("doc_id", "text", "source"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: models, hash fingerprints and sequential packing have no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. Each result is written, and then what the stage and its input left behind is deleted; the tables
    that the last result reads stay in the shared folder as long as its owner wants."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with recorded_scratch() as spent:
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        remove_scratch(spark, [*spent, *before])
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
