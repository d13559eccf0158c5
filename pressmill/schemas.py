"""Explicit schemas of landed input and state tables."""
from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("url_hash", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_confidence", T.StringType()),  # text, so that junk becomes a reject
    T.StructField("tier", T.IntegerType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
])

STORY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("rank", T.LongType()),
])

RSS_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("pubDate", T.StringType()),
])

_ATOM_TEXT = T.StructType([
    T.StructField("_VALUE", T.StringType()),
    T.StructField("_type", T.StringType()),
])
ATOM_ENTRY = T.StructType([
    T.StructField("title", _ATOM_TEXT),
    T.StructField("link", T.ArrayType(T.StructType([
        T.StructField("_href", T.StringType()),
        T.StructField("_rel", T.StringType()),
    ]))),
    T.StructField("summary", _ATOM_TEXT),
    T.StructField("published", T.StringType()),
    T.StructField("updated", T.StringType()),
])

SOURCE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("tier", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("enabled", T.BooleanType()),
])

SCORES = T.StructType([
    T.StructField(axis, T.DoubleType())
    for axis in ("relevance", "novelty", "impact", "taiwan_related", "market_signal")
])

PUBLISHED_ARTICLE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("insight", T.StringType()),
    T.StructField("perspective", T.StringType()),
    T.StructField("importance", T.StringType()),
    T.StructField("market_impact", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("final_score", T.DoubleType()),
    T.StructField("scores", SCORES),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("embedding_id", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("section", T.StringType()),
    T.StructField("url_hash", T.StringType()),
])

EMBEDDING = T.StructType([
    T.StructField("url_hash", T.StringType(), False),
    T.StructField("vector", T.ArrayType(T.DoubleType())),
])

TREND = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("window_days", T.IntegerType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("occurrences", T.LongType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("samples", T.ArrayType(T.StringType())),
])

RUN = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])

CANDIDATE = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("host", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("suggested_at", T.TimestampType()),
])
