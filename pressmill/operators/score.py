"""Scores, policy boost, publishable rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions.binding import bound
from ..params import Settings


def scored(articles: DataFrame, cfg: Settings, as_of: Column) -> DataFrame:
    """Adds the five axes and ``final_score``."""
    hay = S.haystack(F.col("title"), F.col("description"))
    with_hay = bound(articles, {"_hay": hay})
    with_hits = bound(with_hay, {
        "_hits": S.hits(F.col("_hay"), cfg.high_impact),
        "taiwan_related": S.keyword_axis(F.col("_hay"), cfg.taiwan_related),
        "market_signal": S.keyword_axis(F.col("_hay"), cfg.market_signal),
    }).drop("_hay")
    with_axes = with_hits.withColumns({
        "relevance": S.relevance(F.col("source_confidence"), F.col("_hits")),
        "novelty": S.novelty(F.col("published_at"), as_of),
        "impact": S.impact(F.col("description"), F.col("_hits")),
    }).drop("_hits")
    return with_axes.withColumn(
        "final_score", S.weighted({a: F.col(a) for a in S.AXES}, F.col("tier"), cfg))


def policy_boosted(articles: DataFrame, cfg: Settings) -> DataFrame:
    """Adds ``policy_flag`` and lifts the score of flagged rows; a summary counts when there is one."""
    texts = [F.col(c) for c in ("title", "description", "summary") if c in articles.columns]
    with_hay = bound(articles, {"_hay": S.haystack(*texts)})
    flagged = bound(with_hay, {"policy_flag": S.any_of(F.col("_hay"), cfg.policy_keywords)}).drop("_hay")
    return flagged.withColumn(
        "final_score",
        F.when(F.col("policy_flag"), F.round(F.col("final_score") + cfg.policy_boost, 3))
        .otherwise(F.col("final_score")))


def publishable(articles: DataFrame, cfg: Settings) -> DataFrame:
    return articles.filter(
        (F.col("final_score") >= cfg.final_score_min) & (F.col("source_confidence") >= cfg.confidence_min))
