"""The supplied tables seen as articles, vectors, occurrences and usage.

Every field is a fixed rule over the given columns, in Spark and once more as SQL text, so that both
sides of a check start from the same rows.
"""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bound
from ..functions.text import WHITESPACE, squeeze, token_cost
from ..functions.times import instant
from ..params import Settings
from ..session import configure, fan_out

TEXT_TABLES = ("documents", "pages")  # heavy work per row

AS_OF_TEXT = "2024-01-31 00:00:00"

# Keyword lists that occur in the supplied prose (it is invented, in four languages).
CORPUS = replace(
    Settings(),
    high_impact=["eriner", "attion", "thanea", "pour", "nicht", "para", "rely", "ernd"],
    taiwan_related=["thanedble", "dans", "sich", "los"],
    market_signal=["reedes", "esndha", "auf", "una"],
    policy_keywords=["therhean", "dem", "haing", "sur"],
    section_rules=[
        ("giants_market", ["thanea", "pas"]),
        ("dev_tools_agent", ["attion", "les"]),
        ("generative_media", ["eriner", "von"]),
        ("edu_tech", ["rely", "que"]),
        ("infra_open_source", ["thing", "mit"]),
        ("law_ethics_society", ["esndha", "haing"]),
    ],
    perspective_rules=[
        ("policy", ["thanedble", "dans"]),
        ("education", ["thth", "sich"]),
        ("market", ["anea", "des"]),
        ("ecosystem", ["tion", "ein"]),
    ],
    default_perspective="media",
    tag_rules=[("the", "t-the"), ("ing", "t-ing"), ("ble", "t-ble"), ("und", "t-und"), ("que", "t-que"),
               ("eau", "t-eau"), ("ment", "t-ment")],
    title_threshold=92.0,
    vector_threshold=0.35,
    cluster_threshold=0.30,
    final_score_min=5.5,
    daily_token_budget=4000,
    monthly_token_budget=60000,
    permalink_prefix="/site",
)


def as_of() -> Column:
    return instant(AS_OF_TEXT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return fan_out(df) if name in TEXT_TABLES else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document."""
    docs = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    number = F.substr("source", F.lit(4)).cast("int")
    published = as_of() - F.make_dt_interval(hours=doc * 37 % 120, mins=doc % 60)
    clean = bound(docs.select("doc_id", "text", "lang", "source"), {
        "title": squeeze(F.substring_index("text", "\n", 1)), "description": squeeze(F.col("text")),
        "url_hash": F.left(F.sha2("text", 256), F.lit(16))})
    return clean.select(
        doc.alias("arrival"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/a/"), doc.cast("string")).alias("url"),
        "url_hash", "title", "description", F.col("description").alias("summary"),
        F.when(doc % 3 == 0, "").otherwise("noted").alias("insight"),
        F.lit(None).cast("string").alias("market_impact"),
        F.when(doc % 10 == 0, "critical").when(doc % 10 < 4, "high").otherwise("medium").alias("importance"),
        F.col("source").alias("source_id"), F.col("source").alias("source_name"),
        ((50 + number * 7 % 10 * 5) / 100.0).cast("double").alias("source_confidence"),
        (doc % 4 + 1).cast("int").alias("tier"),
        F.when(doc % 17 != 0, published).alias("published_at"),
        (as_of() - F.make_dt_interval(days=doc * 13 % 40, hours=F.lit(1))).alias("fetched_at"),
        F.date_sub(F.lit("2024-01-30").cast("date"), (doc % 30).cast("int")).alias("date"),
        "lang",
    )


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(arrival, title) of ``articles``, without reading the rest of a text more than once."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("arrival"), squeeze(F.substring_index("text", "\n", 1)).alias("title"))


def squeeze_sql(col: str) -> str:
    return f"trim(regexp_replace(coalesce({col}, ''), '{WHITESPACE}+', ' ', 'g'), ' ')"


ARTICLES_SQL = f"""art AS (
  SELECT doc_id AS arrival,
    'https://' || source || '.example.org/a/' || doc_id AS url,
    left(sha256(text), 16) AS url_hash,
    {squeeze_sql("split_part(text, chr(10), 1)")} AS title,
    {squeeze_sql("text")} AS description,
    {squeeze_sql("text")} AS summary,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'noted' END AS insight,
    CASE WHEN doc_id % 10 = 0 THEN 'critical' WHEN doc_id % 10 < 4 THEN 'high' ELSE 'medium' END AS importance,
    source AS source_id, source AS source_name,
    (50 + CAST(substr(source, 4) AS INTEGER) * 7 % 10 * 5) / 100.0::DOUBLE AS source_confidence,
    CAST(doc_id % 4 + 1 AS INTEGER) AS tier,
    CASE WHEN doc_id % 17 <> 0 THEN TIMESTAMP '{AS_OF_TEXT}' - to_hours(CAST(doc_id * 37 % 120 AS INTEGER))
      - to_minutes(CAST(doc_id % 60 AS INTEGER)) END AS published_at,
    TIMESTAMP '{AS_OF_TEXT}' - to_days(CAST(doc_id * 13 % 40 AS INTEGER)) - to_hours(1) AS fetched_at,
    CAST(DATE '2024-01-30' - CAST(doc_id % 30 AS INTEGER) AS DATE) AS date,
    lang
  FROM documents)"""


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term occurrences over time: one per event, the term is type and key."""
    events = table(spark, sf_dir, "events")
    key = F.from_json("props", "k INT")["k"]
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.concat_ws("_", "event_type", key.cast("string")).alias("term"))


OCCURRENCES_SQL = """occ AS (
  SELECT event_id, ts, user_id, event_type, value,
    event_type || '_' || CAST(json_extract_string(props, '$.k') AS INTEGER) AS term
  FROM events)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("arrival"), F.col("embedding").cast("array<double>").alias("embedding"), "label",
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("title"),
        (as_of() - F.make_dt_interval(days=F.col("vec_id") % 30, hours=F.col("vec_id") % 24)).alias("fetched_at"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls: tokens by text size, one month of thirty days."""
    calls = table(spark, sf_dir, "conversations")
    return calls.select(
        "conv_id", "turn", F.lit("2024-01").alias("month"), (F.col("conv_id") % 30).alias("day"),
        F.col("role").alias("kind"), token_cost(F.col("text")).alias("tokens"))


LEDGER_SQL = """led AS (
  SELECT conv_id, turn, '2024-01' AS month, conv_id % 30 AS day, role AS kind,
    CAST(greatest(1, length(text) // 3) AS BIGINT) AS tokens
  FROM conversations)"""
