"""Section, perspective and tags by rule tables; defaults for rows without model output."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.binding import bound
from ..functions.scoring import haystack
from ..params import DEFAULT_TAG, Settings


def classified(articles: DataFrame, cfg: Settings) -> DataFrame:
    """Adds section, perspective and tags from the whole title and text."""
    sections = [s[0] for s in cfg.sections]
    texts = bound(articles, {
        "_hay": haystack(F.col("title"), F.col("description")),
    })
    return bound(texts, {
        "section": R.valid_or(R.first_match(F.col("_hay"), cfg.section_rules, cfg.default_section),
                              sections, cfg.default_section),
        "perspective": R.first_match(F.col("_hay"), cfg.perspective_rules, cfg.default_perspective),
        "tags": R.tags(F.col("_hay"), cfg.tag_rules, DEFAULT_TAG),
    }).drop("_hay")


def enriched(articles: DataFrame, answers: DataFrame | None, cfg: Settings) -> DataFrame:
    """Joins model answers (one row per url_hash) where there are any, and fills the rest by rule.

    An answer wins where it is given: title (24 characters), summary, importance, tags (5), insight,
    perspective, market_impact, section. Without an answer the summary is the head of the description.
    """
    fields = {"title": "string", "summary": "string", "importance": "string", "tags": "array<string>",
              "insight": "string", "perspective": "string", "market_impact": "string", "section": "string"}
    if answers is None:
        joined = articles.withColumns({f"_a_{n}": F.lit(None).cast(t) for n, t in fields.items()})
    else:
        given = answers.select("url_hash", *[
            (F.col(n) if n in answers.columns else F.lit(None)).cast(t).alias(f"_a_{n}")
            for n, t in fields.items()])
        joined = articles.join(given, "url_hash", "left")
    head = F.left(F.col("description"), F.lit(200))
    # rules see the untouched title, the later fields the answered one
    base = joined.withColumn("summary", F.coalesce(F.nullif(F.col("_a_summary"), F.lit("")), head))
    ruled = classified(base, cfg)
    sections = [s[0] for s in cfg.sections]
    return ruled.withColumns({
        "title": F.coalesce(F.nullif(F.left(F.col("_a_title"), F.lit(24)), F.lit("")), F.col("title")),
        "importance": F.coalesce(F.col("_a_importance"), F.lit("medium")),
        "tags": F.slice(F.coalesce(F.col("_a_tags"), F.col("tags")), 1, 5),
        "insight": F.coalesce(F.col("_a_insight"), F.lit("")),
        "perspective": F.coalesce(F.col("_a_perspective"), F.col("perspective")),
        "market_impact": F.col("_a_market_impact"),
        "section": F.when(F.col("_a_section").isin(sections), F.col("_a_section"))
        .when(F.col("_a_section").isNull(), F.col("section")).otherwise(F.lit(cfg.default_section)),
    }).drop(*[f"_a_{n}" for n in fields])
