"""Landed input: raw items, feed files, story files; routing by source type; cached fallback."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scoring import any_of
from ..functions.text import html_text, strip
from ..functions.times import parse_feed_date
from ..functions.urls import key_of, legacy_url
from ..operators.keyed import top_per_key
from ..params import DEFAULT_CONFIDENCE, DEFAULT_FETCH_LIMIT, RELEVANCE_KEYWORDS, STORY_HEAD, STORY_LINK, Settings
from ..session import materialize

FEED_TYPES = ("rss", "atom", "hn_api")


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path (a glob too) leads to something."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def raw_items(spark: SparkSession, path: str) -> DataFrame:
    """JSON arrays of raw items; nothing there gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.RAW)
    return spark.read.schema(schemas.RAW).option("multiLine", True).json(path)


def fetch_limit(tier: Column, cfg: Settings) -> Column:
    chain = None
    for number, limit in cfg.tier_fetch_limit.items():
        chain = F.when(tier == number, limit) if chain is None else chain.when(tier == number, limit)
    return F.lit(DEFAULT_FETCH_LIMIT) if chain is None else chain.otherwise(DEFAULT_FETCH_LIMIT)


def limited(rows: DataFrame, cfg: Settings, position: list[Column], source: str = "source_id") -> DataFrame:
    """The first rows of every source, as many as its tier allows."""
    most = max([DEFAULT_FETCH_LIMIT, *cfg.tier_fetch_limit.values()])
    head = top_per_key(rows, [source], position, most, "_pos")
    return head.filter(F.col("_pos") <= fetch_limit(F.col("tier"), cfg)).drop("_pos")


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds name, tier and confidence of the source; rows carry ``source_id``."""
    facts = sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"), "tier",
        F.coalesce("confidence", F.lit(DEFAULT_CONFIDENCE)).cast("string").alias("source_confidence"))
    return rows.join(facts, "source_id")


def as_raw(rows: DataFrame, as_of: Column) -> DataFrame:
    """Columns of a raw item, key from the collector's own rule."""
    return rows.select(
        "url", key_of(legacy_url(F.col("url"))).alias("url_hash"), strip(F.col("title")).alias("title"),
        strip(F.coalesce("description", F.lit(""))).alias("description"), "source_id", "source_name",
        "source_confidence", "tier", F.col("published_at").cast("timestamp").alias("published_at"),
        as_of.alias("fetched_at"))


def _in_order(df: DataFrame) -> DataFrame:
    """Source and position in its file; feed files are read whole by one task each.

    The source is the folder ``source_id=...`` that a file lies in, or else the name of the file."""
    named = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.[A-Za-z0-9]+$", 1)
    return df.withColumns({
        "source_id": F.col("source_id").cast("string") if "source_id" in df.columns else named,
        "feed_pos": F.monotonically_increasing_id(),
    })


def rss_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of RSS files named <source_id>.xml."""
    rows = spark.read.schema(schemas.RSS_ITEM).option("rowTag", "item").format("xml").load(path)
    return _in_order(rows).select(
        "source_id", "feed_pos", F.col("link").alias("url"), "title", "description",
        parse_feed_date(F.col("pubDate")).alias("published_at"))


def atom_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom files named <source_id>.xml; the link is an attribute."""
    rows = spark.read.schema(schemas.ATOM_ENTRY).option("rowTag", "entry").format("xml").load(path)
    best = F.coalesce(
        F.element_at(F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), 1),
        F.element_at("link", 1))
    return _in_order(rows).select(
        "source_id", "feed_pos", best["_href"].alias("url"), F.col("title._VALUE").alias("title"),
        F.col("summary._VALUE").alias("description"),
        F.coalesce(parse_feed_date(F.col("published")), parse_feed_date(F.col("updated"))).alias("published_at"))


def feed_items(entries: DataFrame, sources: DataFrame, cfg: Settings, as_of: Column) -> DataFrame:
    """Feed entries as raw items: cut to the limit first, then without those that have no link."""
    cut = limited(with_source(entries, sources), cfg, [F.col("feed_pos")])
    linked = cut.filter(F.coalesce(F.trim("url"), F.lit("")) != "")
    text = linked.withColumns({"title": html_text(F.coalesce("title", F.lit(""))),
                               "description": html_text(F.coalesce("description", F.lit("")))})
    return as_raw(text, as_of)


def stories(spark: SparkSession, path: str) -> DataFrame:
    """Story objects, one JSON document per line, in files named <source_id>.json."""
    return _in_order(spark.read.schema(schemas.STORY).json(path))


def story_items(rows: DataFrame, sources: DataFrame, cfg: Settings, as_of: Column) -> DataFrame:
    """Of the first ids: stories on the subject, up to the limit of the tier."""
    head = top_per_key(with_source(rows, sources), ["source_id"], [F.col("rank"), F.col("feed_pos")], STORY_HEAD)
    wanted = head.drop("_rank").filter(
        (F.col("type") == "story") & any_of(F.lower(F.coalesce("title", F.lit(""))), RELEVANCE_KEYWORDS))
    cut = limited(wanted, cfg, [F.col("rank"), F.col("feed_pos")])
    return as_raw(cut.withColumns({
        "url": F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit(STORY_LINK), F.col("id").cast("string"))),
        "description": F.col("text"),
        "published_at": F.timestamp_seconds(F.coalesce("time", F.lit(0))),
    }), as_of)


def routed(sources: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Enabled sources by type, and those of a type nothing can read."""
    enabled = sources.filter(F.coalesce("enabled", F.lit(True)))
    by_type = {t: enabled.filter(F.col("type") == t) for t in FEED_TYPES}
    unknown = enabled.filter(~F.coalesce(F.col("type").isin(*FEED_TYPES), F.lit(False)))
    return by_type, unknown.withColumn("reject_reason", F.lit("unknown source type"))


def scanned(spark: SparkSession, landing: str, sources: DataFrame, cfg: Settings, as_of: Column) -> DataFrame:
    """Raw items of all enabled sources: each type is scanned by its reader below ``landing``/type, and the rows united.

    A type without landed files gives no rows; sources of other types are listed by ``routed``. ``arrival`` follows the
    source and the position in its feed, whatever the file sizes are."""
    by_type, _ = routed(sources)
    rows = spark.createDataFrame([], "source_id string, feed_pos long, url string, title string, description string, published_at timestamp")
    for kind, reader in (("rss", rss_feed), ("atom", atom_feed)):
        if exists(spark, f"{landing}/{kind}"):
            rows = rows.unionByName(reader(spark, f"{landing}/{kind}").join(
                by_type[kind].select(F.col("id").alias("source_id")), "source_id", "left_semi"))
    feeds = by_type["rss"].unionByName(by_type["atom"])
    items = feed_items(rows, feeds, cfg, as_of)
    if exists(spark, f"{landing}/hn_api"):
        items = items.unionByName(story_items(stories(spark, f"{landing}/hn_api"), by_type["hn_api"], cfg, as_of))
    return numbered(items, ["source_id", "published_at", "url"])


def _feed_failures(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, reason) of feed files that are no feed or not well-formed; every file is one row, feeds are small."""
    files = spark.read.text(path, wholetext=True)
    parsed = F.from_xml("value", F.lit("x STRING, _bad STRING"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    reason = (F.when(F.trim("value") == "", "empty file").when(parsed["_bad"].isNotNull(), "broken feed file")
              .when(~F.col("value").rlike(r"<(rss|feed|rdf:RDF)[\s>]"), "not a feed"))
    return _in_order(files).select("source_id", reason.alias("reason")).filter("reason IS NOT NULL")


def _story_failures(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, reason) of lines that hold no JSON object."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", T.StructType([*schemas.STORY, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"})
    return _in_order(lines).filter(parsed["_bad"].isNotNull()).select("source_id", F.lit("broken record").alias("reason"))


def scan_failures(spark: SparkSession, landing: str, sources: DataFrame) -> DataFrame:
    """(source_id, reason, n): what keeps enabled sources from being scanned, files or records counted.

    A source fails when nothing of it landed, or when a file of it can't be parsed to the end; one bad record is enough, as a
    transfer that broke off leaves no other sign."""
    by_type, _ = routed(sources)
    found = spark.createDataFrame([], "source_id string, reason string")
    for kind in FEED_TYPES:
        path, wanted = f"{landing}/{kind}", by_type[kind].select(F.col("id").alias("source_id"))
        here = spark.createDataFrame([], "source_id string")
        if exists(spark, path):
            bad = _story_failures(spark, path) if kind == "hn_api" else _feed_failures(spark, path)
            found = found.unionByName(bad.join(wanted, "source_id", "left_semi"))
            here = _in_order(spark.read.text(path)).select("source_id").distinct()
        found = found.unionByName(wanted.join(here, "source_id", "left_anti").withColumn("reason", F.lit("nothing landed")))
    return found.groupBy("source_id", "reason").agg(F.count(F.lit(1)).alias("n"))


def scanned_or_cached(
    spark: SparkSession, landing: str, sources: DataFrame, cache: DataFrame, cfg: Settings, as_of: Column,
) -> tuple[DataFrame, DataFrame]:
    """(raw items of the sources that could be scanned and cached items of those that failed, with ``from_cache``; the failures).

    What a failed source did deliver is left out, so that it is not mixed with its cached items."""
    failures = materialize(scan_failures(spark, landing, sources), "failures")  # at most a few rows per source
    live = scanned(spark, landing, sources, cfg, as_of).join(F.broadcast(failures.select("source_id").distinct()), "source_id", "left_anti")
    rows = with_cached(live.withColumn("from_cache", F.lit(False)), cache.withColumn("from_cache", F.lit(True)), failures.select("source_id").distinct())
    return rows, failures


def with_cached(live: DataFrame, cache: DataFrame, failed: DataFrame) -> DataFrame:
    """Live rows, and the cached rows of the sources that failed (``failed``: source_id)."""
    return live.unionByName(cache.join(failed.select("source_id"), "source_id", "left_semi"), allowMissingColumns=True)


def numbered(raw: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``arrival``, unique and growing with ``order``; rows are sorted across partitions, not in one."""
    return raw.orderBy(*order).withColumn("arrival", F.monotonically_increasing_id())
