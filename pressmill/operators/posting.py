"""Substring search by an index of character trigrams.

Two tables per archive. ``items`` has the flat articles with a number that grows with their order, by date and sorted by
number. ``postings`` has, by date and bucket of trigrams and sorted by trigram, which items hold a trigram: lists of bounded
length, a common trigram in many of them. The last characters of a text open shorter grams, so a query of one or two characters
is a prefix of grams.

A search reads the buckets of its trigrams and of them the row groups of its trigrams, intersects the lists from the rarest
trigram on, and reads the candidates, newest first and a bounded number at a time, by date and number until enough of them
hold the query. Where a few reads can't be enough, all candidates are joined to the items at once. Trigrams only rule items out; what is returned was compared with the text itself.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .search import _order, haystack

BUCKETS = 16
#: items of one list
RUN = 4096
#: trigrams that are intersected; one this many times as frequent as the rarest is left to the comparison
GRAMS, COMMON = 4, 16
#: candidates read at first, the factor by which later reads grow, and where that ends
FIRST_READ, GROWTH, MOST_READ = 256, 4, 4096


def grams(text: Column) -> Column:
    """Distinct runs of three characters, and the shorter ones at the end."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(.{1,3}))."), F.lit(1)))


def bucket_of(gram: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_postings(items: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Replaces the dates of ``items`` (as of ``flattened``) in the index at ``path`` and leaves the others."""
    order = [c for c in ("section_position", "slot", "url_hash") if c in items.columns]
    laid_out = items.repartitionByRange(F.col("date").desc(), *order).sortWithinPartitions(F.col("date").desc(), *order)
    numbered = materialize(laid_out.withColumn("item", F.monotonically_increasing_id()), "items")

    def replaced(rows: DataFrame, name: str, *partitions: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{path}/{name}")

    replaced(numbered, "items", "date")
    pairs = numbered.select("date", "item", F.explode(grams(haystack())).alias("gram"))
    # a gram of a third of all items is many rows of RUN items at most
    runs = pairs.groupBy("date", "gram", F.floor(F.col("item") / RUN).alias("run")).agg(
        F.array_sort(F.collect_list("item")).alias("items")).drop("run")
    postings = runs.withColumns({"n": F.size("items"), "bucket": bucket_of(F.col("gram"), buckets)})
    replaced(postings.repartitionByRange("date", "bucket", "gram").sortWithinPartitions("date", "bucket", "gram"), "postings", "date", "bucket")


def candidates(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """(date, item) that hold the rarest trigrams of a query of lower case."""
    postings = spark.read.parquet(f"{path}/postings")
    if len(query) < 3:
        held = postings.where(F.startswith("gram", F.lit(query)))
        return held.select("date", F.explode("items").alias("item")).distinct()
    wanted = list(dict.fromkeys(query[i:i + 3] for i in range(len(query) - 2)))
    of = {r["gram"]: r["bucket"] for r in spark.createDataFrame([(g,) for g in wanted], "gram string").select(
        "gram", bucket_of(F.col("gram"), buckets).alias("bucket")).collect()}
    held = postings.where(F.col("bucket").isin(*set(of.values())) & F.col("gram").isin(*wanted))
    counts = {r["gram"]: r["n"] for r in held.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # one row per trigram of the query
    if len(counts) < len(wanted):
        return held.limit(0).select("date", F.explode("items").alias("item"))
    rare = sorted(wanted, key=lambda g: (counts[g], g))[:GRAMS]
    rare = [g for g in rare if counts[g] <= COMMON * counts[rare[0]]]

    def of_gram(gram: str) -> DataFrame:
        return postings.where((F.col("bucket") == of[gram]) & (F.col("gram") == gram)).select("date", F.explode("items").alias("item"))

    def meet(left: DataFrame, gram: str) -> DataFrame:
        right = of_gram(gram).select(F.col("date").alias("held_date"), F.col("item").alias("held_item"))
        same = F.col("date").eqNullSafe(F.col("held_date")) & (F.col("item") == F.col("held_item"))  # a null date is a day like any other
        return left.join(right, same, "left_semi")

    return reduce(meet, rare[1:], of_gram(rare[0]))


def search_postings(spark: SparkSession, path: str, query: str, limit: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """Items whose text contains the query, any case, newest edition first; the same rows as ``search``."""
    items = spark.read.parquet(f"{path}/items")
    q = query.strip().lower()
    if not q:
        return items.limit(0).drop("item")
    found = materialize(candidates(spark, path, q, buckets), "candidates")
    total, taken, hits, size = found.count(), 0, 0, max(FIRST_READ, limit)
    newest = [F.col("date").desc(), F.col("item")]
    chosen = items.limit(0)
    while taken < total and hits < limit:
        if limit > MOST_READ or size == MOST_READ:
            keys = found.select(F.col("date").alias("held_date"), F.col("item").alias("held_item"))
            same = items["date"].eqNullSafe(keys["held_date"]) & (items["item"] == keys["held_item"])
            chosen = items.where(F.contains(haystack(), F.lit(q))).join(keys, same, "left_semi")
            break
        upto = min(total, taken + size)
        head = found.orderBy(*newest).offset(taken).limit(upto - taken).collect()  # a bounded number of keys
        by_date: dict = {}
        for row in head:
            by_date.setdefault(row["date"], []).append(row["item"])
        days = reduce(Column.__or__, [F.col("date").eqNullSafe(F.lit(day)) for day in by_date])
        here = reduce(Column.__or__, [F.col("date").eqNullSafe(F.lit(day)) & F.col("item").isin(*numbers) for day, numbers in by_date.items()])
        numbers = [row["item"] for row in head]
        # days prune partitions and the range of numbers row groups
        more = items.where(days & F.col("item").between(min(numbers), max(numbers)) & here & F.contains(haystack(), F.lit(q)))
        hits += more.count()
        chosen = more if not taken else chosen.unionByName(more)
        taken, size = upto, min(MOST_READ, size * GROWTH)
    return chosen.orderBy(*_order(items)).limit(limit).drop("item")
