"""Hosts that recur outside the known sources."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import mention
from ..functions.urls import host
from .keyed import top_per_key

BROADCAST_ROWS = 100_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``limit`` rows; otherwise left to the planner."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def unknown_hosts(articles: DataFrame, registry: DataFrame) -> DataFrame:
    """Articles whose host is not that of a known source; rows without a host are left out."""
    known = registry.select(host(F.col("url")).alias("host")).distinct()
    with_host = articles.withColumn("host", host(F.col("url"))).filter(F.col("host") != "")
    return with_host.join(small(known), "host", "left_anti")


def source_candidates(articles: DataFrame, registry: DataFrame, top: int = 10, least: int = 2) -> DataFrame:
    """The most frequent unknown hosts with count, score, first titles as reason."""
    strangers = unknown_hosts(articles, registry)
    counts = (
        strangers.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min("arrival").alias("_first"))
        .orderBy(F.col("n").desc(), "_first").limit(top).filter(F.col("n") >= least)
    )
    # ``counts`` has ``top`` rows at most
    titles = (
        top_per_key(strangers.join(F.broadcast(counts.select("host")), "host", "left_semi"),
                    ["host"], [F.col("arrival")], 2)
        .groupBy("host").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("_rank", "title"))), lambda s: s["title"]).alias("titles"))
    )
    return counts.join(titles, "host").select(
        "host", F.concat(F.lit("https://"), F.col("host"), F.lit("/feed")).alias("url"), "n",
        F.least(F.lit(10.0), F.col("n") * 1.5).alias("score"),
        mention(F.col("n"), F.col("host"), F.col("titles")).alias("reason"))
