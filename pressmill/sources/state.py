"""Reads of dimensions and state tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.times import days_before
from ..params import Settings


def source_registry(spark: SparkSession, cfg: Settings) -> DataFrame:
    return spark.createDataFrame(cfg.known_sources, schemas.SOURCE)


def articles_in_window(articles: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Articles fetched in the last ``days`` days up to ``as_of``; the test on the date prunes partitions."""
    cutoff = days_before(as_of, days)
    inside = articles.filter((F.col("fetched_at") >= cutoff) & (F.col("fetched_at") <= as_of))
    return inside.filter(F.col("date").between(F.to_date(cutoff), F.to_date(as_of))) if "date" in articles.columns else inside


def recent_titles(articles: DataFrame, days: int, as_of: Column) -> DataFrame:
    return articles_in_window(articles, days, as_of).select("url_hash", "title")


def recent_vectors(vectors: DataFrame, articles: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Stored vectors of articles fetched in the last ``days`` days."""
    recent = articles_in_window(articles, days, as_of).select("url_hash")
    return vectors.join(recent, "url_hash", "left_semi")


def edition_of(editions: DataFrame, day: dt.date | str) -> DataFrame:
    return editions.filter(F.col("date") == F.lit(str(day)).cast("date"))


def latest_edition(editions: DataFrame) -> DataFrame:
    return editions.filter(F.col("date") == editions.agg(F.max("date")).scalar())


def edition_or_latest(editions: DataFrame, day: dt.date | str) -> DataFrame:
    """The edition of the day when there is one, else the newest: a choice of one date, then a pruned read."""
    wanted = F.lit(str(day)).cast("date")
    chosen = editions.agg(F.coalesce(F.max(F.when(F.col("date") == wanted, F.col("date"))), F.max("date"))).scalar()
    return editions.filter(F.col("date") == chosen)
