"""Editions: nesting, flattening, index, quality, cards, alerts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..params import SCHEMA_VERSION, Settings

ARTICLE_FIELDS = [
    # name in the edition, name in the article table
    ("title", "title"), ("summary", "summary"), ("insight", "insight"), ("perspective", "perspective"),
    ("importance", "importance"), ("market_impact", "market_impact"), ("source_url", "url"),
    ("source_name", "source_name"), ("confidence_score", "source_confidence"), ("final_score", "final_score"),
]
AXES = ("relevance", "novelty", "impact", "taiwan_related", "market_signal")


def article_struct() -> Column:
    return F.struct(
        *[F.col(old).alias(new) for new, old in ARTICLE_FIELDS],
        F.struct(*[F.col(a) for a in AXES]).alias("scores"),
        F.col("tags"), F.col("url_hash").alias("embedding_id"), F.col("published_at"), F.col("section"),
        F.col("url_hash"),
    )


def nested(placed: DataFrame, cfg: Settings, date: str = "date") -> DataFrame:
    """One row per date with all sections in order; a section holds ``per_section_max`` articles at most."""
    filled = placed.groupBy(date, "placed_section").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", article_struct().alias("a")))),
                    lambda s: s["a"]).alias("articles"))
    by_section = filled.groupBy(date).agg(
        F.map_from_entries(F.collect_list(F.struct("placed_section", "articles"))).alias("_found"))
    kind = filled.schema["articles"].dataType.simpleString()
    sections = F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(icon).alias("icon"), F.lit(label).alias("label"),
                 F.coalesce(F.col("_found")[i], F.array().cast(kind)).alias("articles"))
        for i, icon, label in cfg.sections])
    return by_section.select(date, F.lit(SCHEMA_VERSION).alias("schema_version"), sections.alias("sections"))


def flattened(editions: DataFrame, cfg: Settings) -> DataFrame:
    """One row per published article: the search table."""
    section = editions.select("date", F.posexplode("sections").alias("section_position", "s")).select(
        "date", "section_position", F.col("s.id").alias("section"), F.col("s.label").alias("section_label"), "s.articles")
    article = section.select("date", "section_position", "section", "section_label",
                             F.posexplode("articles").alias("slot", "a"))
    return article.select(
        "date", "a.title", "a.summary", "a.insight", "a.tags", "section", "section_label", "a.source_url",
        "a.source_name", "a.url_hash",
        F.concat(F.lit(cfg.permalink_prefix), F.lit("/archive/"), F.col("date").cast("string"), F.lit("/#"),
                 F.col("a.url_hash")).alias("permalink"), "section_position", "slot")


def n_articles(sections: Column | str = "sections") -> Column:
    return F.aggregate(sections, F.lit(0), lambda n, s: n + F.size(s["articles"]))


def edition_index(editions: DataFrame) -> DataFrame:
    """Articles per edition, newest first."""
    keep = [c for c in ("generated_at",) if c in editions.columns]
    return editions.select("date", *keep, n_articles().alias("article_count")).orderBy(F.col("date").desc())


def listed(index: DataFrame, cfg: Settings) -> DataFrame:
    """The newest rows of the edition index with their position, and which of them the front page shows."""
    newest = index.orderBy(F.col("date").desc()).limit(cfg.editions_listed)
    place = F.row_number().over(Window.orderBy(F.col("date").desc()))  # over the few rows that are left
    return newest.withColumn("position", place).withColumn("on_front", F.col("position").between(*cfg.editions_front))


def shown_trends(editions: DataFrame, cfg: Settings) -> DataFrame:
    """Editions with the trends that a page shows, each with its first samples."""
    return editions.withColumn("trends", F.transform(F.slice("trends", 1, cfg.trends_shown), lambda t: t.withField(
        "samples", F.slice(t["samples"], 1, cfg.samples_shown))))


def evaluated(editions: DataFrame, cfg: Settings, drops: DataFrame | None = None) -> DataFrame:
    """Quality of each edition: components, overall mark, warnings.

    ``drops`` (date, dropped) gives the rows lost in dedup. An edition is bounded by its quotas, so
    everything is an expression on its nested column.
    """
    arts = F.flatten(F.transform("sections", lambda s: s["articles"]))
    df = editions.select("date", "sections", arts.alias("_a")).withColumn("n_articles", F.size("_a"))
    n = F.col("n_articles")
    ok = F.size(F.filter("sections", lambda s: F.size(s["articles"]) >= cfg.per_section_min))
    mean = F.aggregate("_a", F.lit(0.0), lambda t, a: t + F.coalesce(a["final_score"], F.lit(0.0))) / F.greatest(n, F.lit(1))
    with_insight = F.size(F.filter("_a", lambda a: F.coalesce(a["insight"], F.lit("")) != ""))
    sources = F.size(F.array_distinct(F.transform("_a", lambda a: a["source_name"])))
    some = n > 0

    def part(value: Column) -> Column:
        return F.when(some, value).otherwise(F.lit(0.0))

    df = df.withColumns({
        "coverage": part(ok / F.size("sections")),
        "diversity": part(F.least(F.lit(1.0), sources / F.greatest(F.lit(4.0), n / 2))),
        "quality": part(mean / 10),
        "insight_rate": part(with_insight / F.greatest(n, F.lit(1))),
    })
    df = df.join(drops, "date", "left") if drops is not None else df.withColumn("dropped", F.lit(0).cast("long"))
    warnings = F.array_compact(F.array(
        F.when(F.col("coverage") < 0.8, P.WARN_COVERAGE),
        F.when(n < cfg.min_articles, P.WARN_FEW),
        F.when(F.coalesce("dropped", F.lit(0)) > n * 3, P.WARN_DROPS),
    ))
    return df.withColumns({
        "overall": F.round(F.col("coverage") * 0.35 + F.col("diversity") * 0.20
                           + F.col("quality") * 0.30 + F.col("insight_rate") * 0.15, 3),
        "warnings": F.when(some, warnings).otherwise(F.array(F.lit(P.WARN_EMPTY))),
    }).withColumns({c: F.round(c, 3) for c in ("coverage", "diversity", "quality", "insight_rate")}).drop(
        "sections", "_a", "dropped")


def cards(editions: DataFrame, trend_counts: DataFrame | None = None) -> DataFrame:
    """Dashboard rows per edition: (date, position, label, value)."""
    arts = F.flatten(F.transform("sections", lambda s: s["articles"]))
    df = editions.select("date", arts.alias("_a"))
    df = df.join(trend_counts, "date", "left") if trend_counts is not None else df.withColumn("n_trends", F.lit(0))
    values = [
        (P.CARD_ARTICLES, F.size("_a")),
        (P.CARD_SOURCES, F.size(F.array_distinct(F.transform("_a", lambda a: a["source_name"])))),
        (P.CARD_IMPACT, F.size(F.filter("_a", lambda a: F.coalesce(a["importance"].isin("high", "critical"), F.lit(False))))),
        (P.CARD_TRENDS, F.coalesce("n_trends", F.lit(0)).cast("int")),
    ]
    return df.select("date", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"), value.cast("string").alias("value"))
        for i, (label, value) in enumerate(values, 1)])))


def alerts(days: DataFrame, cfg: Settings) -> DataFrame:
    """Alert rows per day from (date, n_articles, email_ok, publish_ok, errors).

    ``n_articles`` is null when there is no edition.
    """
    n = F.col("n_articles")
    errors = F.filter("errors", lambda e: F.coalesce(e, F.lit("")) != "")
    fired = F.array_compact(F.array(
        F.when(n.isNull(), P.ALERT_NO_EDITION),
        F.when(n < cfg.min_articles, F.concat(
            F.lit(P.ALERT_FEW), n.cast("string"), F.lit(f" < {cfg.min_articles}"))),
        F.when(~F.col("email_ok"), P.ALERT_MAIL),
        F.when(~F.col("publish_ok"), P.ALERT_PUBLISH),
        F.when(F.size(errors) > 0, F.concat(F.lit(P.ALERT_ERRORS), F.array_join(F.slice(errors, 1, 3), "; "))),
    ))
    return days.select("date", F.posexplode(fired).alias("position", "message"))
