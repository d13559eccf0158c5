"""Search by trigram index against search by reading everything."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pressmill.operators import posting
from pressmill.operators.search import search

ITEM = ("date date, title string, summary string, insight string, tags array<string>, section string, section_label string, "
        "url_hash string, section_position int, slot int")


def made_items(n, seed, first=dt.date(2026, 5, 1), days=4):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gam ma", "über", "模型", "開源模型", "a.b", "100%", "x", "\\Q", "👍👍👍"]
    rows = []
    for i in range(n):
        pick = lambda k: " ".join(rng.choices(words, k=rng.randint(0, k)))
        rows.append((first + dt.timedelta(days=rng.randrange(days)), rng.choice([None, pick(3), pick(6)]), pick(5), rng.choice([None, "", pick(2)]),
                     rng.sample(words, rng.randint(0, 3)), "s", rng.choice(["巨頭", "Dev tools", None]), f"h{i:04d}", rng.randrange(3), rng.randrange(3)))
    return rows


def names(frame):
    return [r["url_hash"] for r in frame.collect()]


QUERIES = ["beta", "ALPHA", "a", "ga", "模型", "開源模", "ma ü", "a.b", "100%", "\\q", "👍", "👍👍👍", "beta beta", "dev tool", "nothing", "", "  ", "zzz beta"]


@pytest.mark.parametrize("limit", [5, 1000])
def test_same_rows_as_a_full_read(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(posting, "FIRST_READ", 8)
    monkeypatch.setattr(posting, "RUN", 16)
    items = spark.createDataFrame(made_items(150, 1), ITEM).repartition(3)
    path = str(tmp_path / "index")
    posting.write_postings(items, path, buckets=4)
    for q in QUERIES:
        assert names(posting.search_postings(spark, path, q, limit, buckets=4)) == names(search(items, q, limit)), q


def test_one_date_is_replaced(spark, tmp_path):
    path = str(tmp_path / "index")
    old = spark.createDataFrame(made_items(60, 2), ITEM)
    posting.write_postings(old, path)
    again = spark.createDataFrame(made_items(40, 3, dt.date(2026, 5, 2), 1), ITEM)
    posting.write_postings(again, path)
    now = old.where("date <> DATE'2026-05-02'").unionByName(again)
    for q in QUERIES:
        assert names(posting.search_postings(spark, path, q, 1000)) == names(search(now, q, 1000)), q


def test_reads_only_what_the_query_needs(spark, tmp_path):
    path = str(tmp_path / "index")
    items = spark.createDataFrame(made_items(80, 4), ITEM).withColumn("title", F.concat("title", F.lit(" rare"), F.col("slot").cast("string"), "url_hash"))
    posting.write_postings(items, path)
    plan = posting.candidates(spark, path, "rare1h0007")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(gram," in plan
    short = posting.candidates(spark, path, "ra")._jdf.queryExecution().toString()
    assert "StringStartsWith(gram,ra)" in short
    found = posting.search_postings(spark, path, "rare1h00")
    text = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[\(*date", text) and "GreaterThanOrEqual(item," in text


def test_empty_and_odd(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(None, "no date", None, None, None, None, None, "h1", None, None), (dt.date(2026, 1, 1), None, None, None, None, None, None, "h2", 0, 0)]
    posting.write_postings(spark.createDataFrame(rows, ITEM), path)
    assert names(posting.search_postings(spark, path, "NO da")) == ["h1"]
    assert names(posting.search_postings(spark, path, "e")) == ["h1"]
    other = str(tmp_path / "none")
    posting.write_postings(spark.createDataFrame([], ITEM).withColumn("date", F.lit(dt.date(2026, 1, 1))).unionByName(
        spark.createDataFrame(rows[1:], ITEM)), other)
    assert names(posting.search_postings(spark, other, "e")) == []


def test_grams(spark):
    got = spark.createDataFrame([("abcab",), ("a",), ("",), (None,), ("x\ny👍",)], "t string").select(posting.grams(F.col("t")).alias("g")).collect()
    assert [r["g"] for r in got] == [["abc", "bca", "cab", "ab", "b"], ["a"], [], None, ["x\ny", "\ny👍", "y👍", "👍"]]
