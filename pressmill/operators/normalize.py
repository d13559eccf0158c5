"""Raw items to articles, and the rows that cannot become one."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze, strip
from ..functions.times import parse_iso
from ..functions.urls import canonical_url, url_key
from ..params import DEFAULT_CONFIDENCE


def with_defaults(raw: DataFrame) -> DataFrame:
    """Missing names, confidences and texts get their defaults."""
    return raw.withColumns({
        "source_name": F.coalesce(F.col("source_name"), F.col("source_id")),
        "source_confidence": F.coalesce(
            F.col("source_confidence").try_cast("double"),
            F.when(F.col("source_confidence").isNull(), F.lit(DEFAULT_CONFIDENCE))),
        "title": squeeze(F.col("title")),
        "description": squeeze(F.col("description")),
    })


def reject_reason() -> Column:
    """Why a raw row cannot become an article; null when it can."""
    return (
        F.when(F.coalesce(strip(F.col("url")), F.lit("")) == "", "missing url")
        .when(F.col("source_id").isNull(), "missing source_id")
        .when(
            F.col("source_confidence").isNotNull()
            & F.col("source_confidence").try_cast("double").isNull(),
            "bad source_confidence")
    )


def rejects(raw: DataFrame) -> DataFrame:
    return raw.withColumn("reject_reason", reject_reason()).filter(F.col("reject_reason").isNotNull())


def normalize(raw: DataFrame, as_of: Column) -> DataFrame:
    """Articles with canonical URL, key, cleaned text and parsed times."""
    canonical = canonical_url(F.col("url"))
    return with_defaults(raw.filter(reject_reason().isNull())).withColumns({
        "url": canonical,
        "url_hash": url_key(canonical, F.col("url_hash")),
        "published_at": parse_iso(F.col("published_at")),
        "fetched_at": F.coalesce(parse_iso(F.col("fetched_at")), as_of),
    })
