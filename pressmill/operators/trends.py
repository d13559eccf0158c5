"""Term trends over trailing windows, velocity against the last stored value, samples, bursts."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import band
from ..functions.text import exploded_terms, is_cjk, term_text
from ..functions.times import days_before
from ..params import Settings
from .keyed import top_per_key


def article_terms(articles: DataFrame, keep: list[str]) -> DataFrame:
    """One row per term occurrence."""
    text = term_text(F.col("title"), F.coalesce("description", "summary"), F.col("tags"))
    return exploded_terms(articles, keep, text)


def term_counts(occurrences: DataFrame, term: str = "term") -> DataFrame:
    return occurrences.groupBy(F.col(term).alias("keyword")).agg(F.count(F.lit(1)).alias("n"))


def window_counts(
    occurrences: DataFrame, windows: tuple[int, ...], as_of: Column, ts: str = "ts", term: str = "term",
) -> DataFrame:
    """Occurrences per (window_days, keyword) for nested trailing windows that end with ``as_of``, in one pass over the rows."""
    inside = occurrences.filter((F.col(ts) >= days_before(as_of, max(windows))) & (F.col(ts) <= as_of))
    counts = inside.groupBy(F.col(term).alias("keyword")).agg(*[
        F.count_if(F.col(ts) >= days_before(as_of, w)).alias(f"n_{w}") for w in windows])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(w).alias("window_days"), F.col(f"n_{w}").alias("occurrences")) for w in windows]))
    return counts.select("keyword", stacked).filter(F.col("occurrences") > 0)


def top_terms(counts: DataFrame, cfg: Settings) -> DataFrame:
    """The most frequent terms of each window that recur often enough."""
    best = top_per_key(counts, ["window_days"], [F.col("occurrences").desc(), F.col("keyword")],
                       cfg.trend_top * 3)
    return best.filter(F.col("occurrences") >= cfg.trend_min_count).drop("_rank")


def previous_values(history: DataFrame, day: Column) -> DataFrame:
    """Per (window, keyword) the value of the latest day strictly before ``day``."""
    return (
        history.filter(F.col("date") < day).groupBy("window_days", "keyword")
        .agg(F.max_by("occurrences", "date").alias("prev"))
    )


def with_velocity(counts: DataFrame, previous: DataFrame) -> DataFrame:
    """Relative change against the previous value; the count itself where there is none."""
    joined = counts.join(previous, ["window_days", "keyword"], "left").withColumn(
        "prev", F.coalesce(F.col("prev"), F.lit(0)).cast("long"))
    n, prev = F.col("occurrences"), F.col("prev")
    velocity = F.when(prev > 0, (n - prev) / prev).otherwise(n.cast("double"))
    return joined.withColumn("velocity", F.round(velocity, 3)).withColumn("direction", band(F.col("velocity")))


def velocity_series(daily: DataFrame) -> DataFrame:
    """Velocity of every stored day against the stored day before it (one row per day and term)."""
    order = Window.partitionBy("window_days", "keyword").orderBy("date")
    prev = F.coalesce(F.lag("occurrences").over(order), F.lit(0))
    n = F.col("occurrences")
    return daily.withColumn("prev", prev).withColumn(
        "velocity", F.round(F.when(F.col("prev") > 0, (n - F.col("prev")) / F.col("prev"))
                            .otherwise(n.cast("double")), 3))


def sample_titles(
    articles: DataFrame, keywords: DataFrame, as_of: Column, windows: tuple[int, ...], ts: str = "ts", k: int = 3,
) -> DataFrame:
    """First ``k`` titles, newest first, that contain a keyword, per (window_days, keyword).

    ``keywords`` is the output of ``top_terms``: at most 3 x top terms per window, so it travels as
    one array in a scalar subquery and every title is tested once, without a join.
    """
    wanted = keywords.agg(F.collect_list(F.struct(
        F.col("window_days"), F.col("keyword"), F.lower("keyword").alias("low")))).scalar()
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    found = (
        articles.filter((F.col(ts) >= days_before(as_of, max(windows))) & (F.col(ts) <= as_of))
        .select(ts, "arrival", "title", title.alias("_low"), wanted.alias("_wanted"))
        .select(ts, "arrival", "title", F.inline(F.filter(
            "_wanted", lambda w: F.contains(F.col("_low"), w["low"]))))
        .filter(F.col(ts) >= as_of - F.make_dt_interval(F.col("window_days")))
    )
    best = top_per_key(found, ["window_days", "keyword"], [F.col(ts).desc(), F.col("arrival")], k)
    return best.groupBy("window_days", "keyword").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", "title"))), lambda s: s["title"]).alias("samples"))


def trends(articles: DataFrame, history: DataFrame, day: dt.date, as_of: Column, cfg: Settings) -> DataFrame:
    """All trend rows of a day, to be stored whole: the next day's velocities need every one of them."""
    occurrences = article_terms(articles, ["ts"])
    top = top_terms(window_counts(occurrences, cfg.trend_windows, as_of), cfg)
    moved = with_velocity(top, previous_values(history, F.lit(day)))
    samples = sample_titles(articles, top, as_of, cfg.trend_windows)
    return (
        moved.join(samples, ["window_days", "keyword"], "left")
        .withColumns({"date": F.lit(day),
                      "samples": F.coalesce(F.col("samples"), F.array().cast("array<string>"))})
    )


def fastest(moved: DataFrame, cfg: Settings) -> DataFrame:
    """The trend rows that an edition shows."""
    order = [F.col("velocity").desc(), F.col("occurrences").desc(), F.col("window_days"), F.col("keyword")]
    return moved.orderBy(*order).limit(cfg.trend_top * len(cfg.trend_windows))


def bursts(
    occurrences: DataFrame, documents: DataFrame, as_of: Column, cfg: Settings, ts: str = "ts", term: str = "term",
) -> DataFrame:
    """Terms whose rate per document rose against the longer baseline.

    Both windows are counted in one pass; the two document counts come in as a scalar subquery.
    """
    recent = F.col(ts) >= days_before(as_of, cfg.burst_days)
    baseline = (F.col(ts) >= days_before(as_of, cfg.burst_baseline_days)) & (F.col(ts) <= as_of)
    totals = documents.filter(baseline).agg(F.struct(
        F.greatest(F.count_if(recent), F.lit(1)).alias("recent"),
        F.greatest(F.count(F.lit(1)), F.lit(1)).alias("base"))).scalar()
    counts = (
        occurrences.filter(baseline).groupBy(F.col(term).alias("keyword"))
        .agg(F.count_if(recent).alias("occurrences_recent"), F.count(F.lit(1)).alias("occurrences_base"))
        .filter(F.col("occurrences_recent") > 0)
        .orderBy(F.col("occurrences_recent").desc(), "keyword").limit(cfg.burst_terms)
    )
    ratio = (F.col("occurrences_recent") / F.col("_totals.recent")) / (F.col("occurrences_base") / F.col("_totals.base"))
    return (
        counts.withColumn("_totals", totals)
        .withColumn("_ratio", ratio)
        .filter((F.col("occurrences_recent") >= cfg.trend_min_count) & (F.col("_ratio") >= cfg.burst_min_ratio))
        .select("keyword", "occurrences_recent", F.round("_ratio", 2).alias("growth_ratio"),
                is_cjk(F.col("keyword")).alias("is_cjk"))
        .orderBy(F.col("growth_ratio").desc(), F.col("occurrences_recent").desc(), "keyword")
        .limit(cfg.burst_top)
    )


def daily_counts(occurrences: DataFrame, ts: str = "ts", term: str = "term") -> DataFrame:
    return occurrences.groupBy(F.to_date(ts).alias("date"), F.col(term).alias("keyword")).agg(
        F.count(F.lit(1)).alias("n"))


def trailing_counts(daily: DataFrame, days: int) -> DataFrame:
    """Trailing sums for every day at once from daily counts; a window holds one row per day at most."""
    order = Window.partitionBy("keyword").orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)
    return daily.select("date", "keyword", F.lit(days).alias("window_days"), F.sum("n").over(order).alias("occurrences"))
