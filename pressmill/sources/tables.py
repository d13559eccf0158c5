"""Writes: parquet state tables, editions, caches, JSON exports.

State lies in partitions that are a function of the key, so an upsert rewrites only the partitions
its keys fall in. Rows go through a written staging table first: a path is never read and
overwritten by the same job.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.edition import edition_index
from ..operators.keyed import absent, first_per_key, ignored_if_present, upserted
from ..session import materialize
from .landed import exists

BUCKETS = 64


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, or no rows when nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _laid_out(df: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Few files per partition, and a heavy partition split over tasks: ranges of (partition, row hash)."""
    plain = [c for c, t in df.dtypes if c not in partitions and not t.startswith(("map", "variant"))]
    return df.repartitionByRange(*partitions, F.xxhash64(*plain) if plain else F.lit(0))


def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replaces the partitions that ``df`` has rows for and leaves the others."""
    _laid_out(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def upsert(new: DataFrame, path: str, keys: list[str], version: str | None = None, partition: str | None = None,
           buckets: int = BUCKETS) -> None:
    """Last write wins: by ``version``, or by the order of the writes without one (then the keys of a write
    are unique). ``partition`` must be one of the keys; without it rows go to hash buckets, whose number must
    stay the same for a table."""
    spark = new.sparkSession
    if partition is None:
        partition = "bucket"
        new = new.withColumn(partition, bucket_of(keys, buckets))
    if exists(spark, path):
        touched = spark.read.schema(new.schema).parquet(path).select(*new.columns).join(new.select(partition).distinct(), partition, "left_semi")
        result = upserted(touched, new, keys, version)
    else:
        result = first_per_key(new, keys, [F.col(version).desc() if version else F.col(keys[0])])
    overwrite_partitions(materialize(result, "upsert"), path, partition)


def insert_ignore(new: DataFrame, path: str, keys: list[str], order: list[Column]) -> None:
    """First write wins."""
    spark = new.sparkSession
    if exists(spark, path):
        rows = ignored_if_present(spark.read.schema(new.schema).parquet(path), new, keys, order)
    else:
        rows = first_per_key(new, keys, order)
    materialize(rows, "insert").write.mode("append").parquet(path)


def append_articles(articles: DataFrame, path: str) -> None:
    """Articles by fetch date. Keys stored already were dropped before; a rerun adds nothing twice."""
    spark = articles.sparkSession
    rows = articles.withColumn("date", F.to_date("fetched_at"))
    if exists(spark, path):
        rows = absent(rows, spark.read.schema("url_hash string").parquet(path), ["url_hash"])
    _laid_out(materialize(rows, "articles"), ("date",)).write.mode("append").partitionBy("date").parquet(path)


def append_run(spark: SparkSession, path: str, run_id: str, status: str, ts: Column, metrics: dict[str, float]) -> None:
    """One status row of a run: running (seq 0), then success or failed (seq 1)."""
    pairs = [x for k, v in metrics.items() for x in (F.lit(k), F.lit(float(v)))]
    values = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(status).alias("status"), ts.alias("ts"),
        F.lit(0 if status == "running" else 1).cast("long").alias("seq"),
        values.cast("map<string,double>").alias("metrics"),
    ).write.mode("append").parquet(path)


def write_edition(edition: DataFrame, path: str) -> None:
    """One partition per date, so a second write of a date replaces the first."""
    overwrite_partitions(edition, path, "date")


def write_cache(raw: DataFrame, path: str) -> None:
    overwrite_partitions(raw, path, "source_id")


def write_bronze(raw: DataFrame, path: str) -> None:
    """All fetched rows, read by the next stage."""
    raw.write.mode("overwrite").parquet(path)


def write_search_index(items: DataFrame, path: str) -> None:
    """Flat article table as JSON lines, one folder per edition date."""
    items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").json(path)


def write_edition_index(editions: DataFrame, path: str) -> None:
    """Index rows of the editions given, one folder per date; those of other dates stay."""
    edition_index(editions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").json(path)


def unindexed(archive: DataFrame, chosen: DataFrame, path: str) -> DataFrame:
    """The chosen edition and those that the index at ``path`` lacks. Dates are partitions on both sides, so of the archive
    only what is missing is read."""
    spark = archive.sparkSession
    dates = archive.select("date").distinct()
    if exists(spark, path):
        dates = dates.join(spark.read.schema("date date").json(path).select("date").distinct(), "date", "left_anti")
    wanted = dates.unionByName(chosen.select("date")).distinct()
    return archive.join(F.broadcast(wanted), "date", "left_semi")  # a few bytes per day
