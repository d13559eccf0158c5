"""Scoring expressions. Keyword tests are plain substring tests, so they stay in generated code."""
from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Settings
from .times import age_hours

AXES = ("relevance", "novelty", "impact", "taiwan_related", "market_signal")


def haystack(*parts: Column) -> Column:
    """Lower-cased text that keywords are looked up in."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def hits(hay: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur in ``hay``."""
    if not keywords:
        return F.lit(0)
    return reduce(add, [F.contains(hay, F.lit(k.lower())).cast("int") for k in keywords])


def any_of(hay: Column, keywords: list[str]) -> Column:
    if not keywords:
        return F.lit(False)
    return reduce(or_, [F.contains(hay, F.lit(k.lower())) for k in keywords])


def relevance(confidence: Column, n_hits: Column) -> Column:
    return F.least(F.lit(10.0), confidence * 10.0 + F.least(n_hits * 1.5, F.lit(3.0)))


def novelty(published_at: Column, as_of: Column) -> Column:
    """Linear decay over 96 hours; 6 when the date is unknown."""
    fresh = F.greatest(F.lit(0.0), 1.0 - age_hours(published_at, as_of) / 96.0)
    return F.when(published_at.isNull(), F.lit(6.0)).otherwise(F.round(fresh * 10.0, 2))


def impact(description: Column, n_hits: Column) -> Column:
    length_bonus = F.when(F.length(description).between(200, 1500), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.least(F.lit(10.0), 5.0 + n_hits * 1.5 + length_bonus)


def keyword_axis(hay: Column, keywords: list[str]) -> Column:
    return F.least(F.lit(10.0), hits(hay, keywords) * 3.0)


def tier_factor(tier: Column, bonus: dict[int, float]) -> Column:
    """No tier counts as tier 2; a tier without an entry has factor 1."""
    known = F.coalesce(F.nullif(tier, F.lit(0)), F.lit(2))
    chain = None
    for number, factor in bonus.items():
        test = known == number
        chain = F.when(test, factor) if chain is None else chain.when(test, factor)
    return F.lit(1.0) if chain is None else chain.otherwise(1.0)


def weighted(axes: dict[str, Column], tier: Column, cfg: Settings) -> Column:
    total = reduce(add, [axes[name] * cfg.weights[name] for name in AXES])
    return F.round(total * tier_factor(tier, cfg.tier_bonus), 3)
