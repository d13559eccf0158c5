"""Exact removal of repeated texts with two-pass Bloom filtering, in built-in functions only.

The first pass hashes every normalised text and counts Bloom bits; the second asks each row whether all its bits were
seen twice. Only rows that may be repeated are shuffled, by their exact key; the rest pass straight through.

Defined results: a null text counts as empty; equal texts keep the row of the smallest id, a null id coming last;
of rows with equal text and equal id one stays; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm import bloom
from pressmill.session import materialize


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, text_sha256)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(normalised(text_col), 256).alias("text_sha256"))
    rows = materialize(rows.select("id", "text_sha256", F.xxhash64("text_sha256").alias("key"), F.monotonically_increasing_id().alias("row")), "hashes")
    words = bloom.filter_words(rows.count(), max_words)
    filters = materialize(bloom.build(rows, "key", words), "bloom")
    flagged = bloom.suspected(rows, "key", filters, words)
    alone = flagged.where(~F.col("suspected")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = flagged.where("suspected").drop("suspected", "key")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row")))
    # written, so that the join below meets two plain shuffles, of which Spark splits a hot key
    groups = materialize(maybe.groupBy("text_sha256").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
    shared = maybe.join(groups, "text_sha256").select(
        "id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")
    return alone.unionByName(shared).withColumnRenamed("id", id_col)
