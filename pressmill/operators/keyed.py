"""Keyed selection: first, latest, absent, and what each dedup layer dropped.

A ``row_number() <= k`` filter is pushed below the shuffle by Spark (window group limit), so a key
that holds a third of all rows sends at most k rows per map task to its reducer.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "_rank") -> DataFrame:
    """The first ``k`` rows of every key; ``rank`` is kept."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1).drop("_rank")


def absent(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(stored.select(*keys), keys, "left_anti")


def new_articles(batch: DataFrame, stored: DataFrame, key: str = "url_hash", arrival: str = "arrival") -> DataFrame:
    """First row per key among those not stored. Keys are made single first: fewer rows to join."""
    return absent(first_per_key(batch, [key], [F.col(arrival)]), stored, [key])


def keyed_drop_counts(batch: DataFrame, stored: DataFrame, key: str = "url_hash") -> DataFrame:
    """One row (by_db, by_url): copies of stored keys, and repeats among the others."""
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    marked = per_key.join(stored.select(key).distinct().withColumn("_stored", F.lit(True)), key, "left")
    return marked.agg(
        F.coalesce(F.sum(F.when(F.col("_stored"), F.col("n"))), F.lit(0)).alias("by_db"),
        F.coalesce(F.sum(F.when(F.col("_stored").isNull(), F.col("n") - 1)), F.lit(0)).alias("by_url"),
    )


def upserted(old: DataFrame, new: DataFrame, keys: list[str], version: str | None) -> DataFrame:
    """Last write wins: per key the row with the highest version, the new row on a tie and where there is no version."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    order = [F.col(version).desc()] if version else []
    return first_per_key(both, keys, [*order, F.col("_side").desc()]).drop("_side")


def ignored_if_present(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First write wins: rows of ``new`` to append."""
    return absent(first_per_key(new, keys, order), old, keys)
