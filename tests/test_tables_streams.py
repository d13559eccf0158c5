import datetime as dt
import json

from pyspark.sql import functions as F

from pressmill.functions.times import instant
from pressmill.params import Settings
from pressmill.sources import landed, state, tables
from pressmill.streaming import jobs

CFG = Settings()
NOW = dt.datetime(2026, 5, 12, 9, 0)


def test_upsert_and_insert(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("b", 2, "y")], "k string, v int, p string")
    tables.upsert(first, path, ["k"], "v", buckets=4)
    tables.upsert(spark.createDataFrame([("b", 3, "n"), ("c", 1, "n"), ("a", 0, "old")], first.schema), path, ["k"], "v", buckets=4)
    got = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()))
    assert got == [("a", 1, "x"), ("b", 3, "n"), ("c", 1, "n")]
    other = str(tmp_path / "i")
    tables.insert_ignore(first, other, ["k"], [F.col("v")])
    tables.insert_ignore(spark.createDataFrame([("a", 9, "no"), ("d", 1, "n")], first.schema), other, ["k"], [F.col("v")])
    assert sorted(map(tuple, spark.read.parquet(other).collect())) == [("a", 1, "x"), ("b", 1, "x"), ("d", 1, "n")]


def test_editions(spark, tmp_path):
    path = str(tmp_path / "archive")
    for day, n in (("2026-05-10", 1), ("2026-05-11", 2), ("2026-05-11", 3)):
        tables.write_edition(spark.createDataFrame([(dt.date.fromisoformat(day), n)], "date date, n int"), path)
    editions = spark.read.parquet(path)
    assert sorted((str(r["date"]), r["n"]) for r in editions.collect()) == [("2026-05-10", 1), ("2026-05-11", 3)]
    assert state.latest_edition(editions).first()["n"] == 3
    assert state.edition_of(editions, "2026-05-10").first()["n"] == 1
    assert state.edition_or_latest(editions, "2026-05-10").first()["n"] == 1
    assert state.edition_or_latest(editions, "2026-06-01").first()["n"] == 3


def test_windows(spark):
    rows = [(f"h{d}", f"t{d}", NOW - dt.timedelta(days=d)) for d in (1, 13, 14, 15)]
    arts = spark.createDataFrame(rows, "url_hash string, title string, fetched_at timestamp").withColumn("date", F.to_date("fetched_at"))
    assert sorted(r["url_hash"] for r in state.recent_titles(arts, 14, instant(NOW)).collect()) == ["h1", "h13", "h14"]
    vecs = spark.createDataFrame([("h1", [1.0]), ("h15", [1.0]), ("hx", [1.0])], "url_hash string, vector array<double>")
    assert [r["url_hash"] for r in state.recent_vectors(vecs, arts, 14, instant(NOW)).collect()] == ["h1"]


def test_feeds(spark, tmp_path):
    items = "".join(
        f"<item><title>T{i} &lt;b&gt;x&lt;/b&gt;</title>{'' if i == 1 else f'<link>https://e.com/{i}</link>'}"
        f"<description>&lt;p&gt;d{i}&lt;/p&gt;</description><pubDate>Tue, 12 May 2026 0{i % 9}:00:00 GMT</pubDate></item>"
        for i in range(25))
    (tmp_path / "openai_blog.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    sources = state.source_registry(spark, CFG)
    got = landed.feed_items(landed.rss_feed(spark, str(tmp_path / "openai_blog.xml")), sources, CFG, instant(NOW)).collect()
    assert len(got) == 19  # twenty by the limit of tier 1, one of them without a link
    row = next(r for r in got if r["url"] == "https://e.com/2")
    assert row["title"] == "T2 x" and row["description"] == "d2" and row["source_name"] == "OpenAI Blog"
    assert row["published_at"] == dt.datetime(2026, 5, 12, 2) and row["tier"] == 1
    (tmp_path / "papers_with_code.xml").write_text(
        '<feed><entry><title type="html">A</title><link rel="self" href="https://s"/><link href="https://a"/>'
        "<summary>s</summary><updated>2026-05-12T01:00:00Z</updated></entry></feed>")
    atom = landed.atom_feed(spark, str(tmp_path / "papers_with_code.xml")).first()
    assert atom["url"] == "https://a" and atom["title"] == "A" and atom["published_at"] == dt.datetime(2026, 5, 12, 1)


def test_stories(spark, tmp_path):
    rows = [{"id": i, "type": "story", "title": f"LLM news {i}", "url": f"https://e.com/{i}", "time": 1778544000, "rank": i} for i in range(40)]
    rows[1]["type"], rows[2]["title"], rows[3]["url"] = "job", "gardening", ""
    (tmp_path / "hacker_news.json").write_text("\n".join(map(json.dumps, rows)))
    sources = state.source_registry(spark, CFG)
    got = landed.story_items(landed.stories(spark, str(tmp_path / "hacker_news.json")), sources, CFG, instant(NOW)).collect()
    assert len(got) == 28  # the first thirty ids, less a job and one off the subject
    assert "https://news.ycombinator.com/item?id=3" in {r["url"] for r in got}


def test_routing_and_fallback(spark, tmp_path):
    sources = spark.createDataFrame([("a", "rss", None), ("b", "hn_api", False), ("c", "gopher", True)], "id string, type string, enabled boolean")
    by_type, unknown = landed.routed(sources)
    assert by_type["rss"].count() == 1 and by_type["hn_api"].count() == 0
    assert [(r["id"], r["reject_reason"]) for r in unknown.collect()] == [("c", "unknown source type")]
    live = spark.createDataFrame([("a", "live")], "source_id string, url string")
    path = str(tmp_path / "cache")
    tables.write_cache(spark.createDataFrame([("a", "old"), ("b", "cached")], live.schema), path)
    tables.write_cache(spark.createDataFrame([("a", "new")], live.schema), path)
    cache = spark.read.parquet(path)
    assert sorted((r["source_id"], r["url"]) for r in cache.collect()) == [("a", "new"), ("b", "cached")]
    failed = spark.createDataFrame([("b",)], "source_id string")
    assert sorted(r["url"] for r in landed.with_cached(live, cache, failed).collect()) == ["cached", "live"]
    assert landed.raw_items(spark, str(tmp_path / "nothing.json")).count() == 0


def event_files(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(folder)


def test_stream_dedup(spark, tmp_path):
    folder, t = str(tmp_path / "in"), dt.datetime(2026, 5, 1)
    event_files(spark, folder, [[("a", t), ("a", t), ("b", t)]])
    schema = spark.read.parquet(folder).schema
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ck")
    for more in ([], [("a", t + dt.timedelta(hours=1)), ("c", t)]):
        if more:
            event_files(spark, folder, [more])
        jobs.append_to(jobs.first_seen(jobs.file_stream(spark, folder, schema), ["k"], "ts", "10 days"), out, ckpt).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_counts_in_two_runs(spark, tmp_path):
    folder, t = str(tmp_path / "in"), dt.datetime(2026, 5, 1)
    log, ckpt = str(tmp_path / "log"), str(tmp_path / "ck")
    event_files(spark, folder, [[("a", t), ("a", t)]])
    schema = spark.read.parquet(folder).schema
    for more in ([], [("a", t + dt.timedelta(hours=2)), ("b", t + dt.timedelta(days=1))]):
        if more:
            event_files(spark, folder, [more])
        counts = jobs.daily_term_counts(jobs.file_stream(spark, folder, schema), "ts", "k", "2 days")
        jobs.upsert_each_batch(counts, log, ckpt).awaitTermination()
    keys = ["date", "keyword"]
    want = [("a", 3), ("b", 1)]
    assert sorted((r["keyword"], r["n"]) for r in jobs.current_rows(spark, log, keys).collect()) == want
    jobs.compacted(spark, log, keys, str(tmp_path / "table"))
    assert sorted((r["keyword"], r["n"]) for r in spark.read.parquet(str(tmp_path / "table")).collect()) == want


def test_sliding_windows_drop_late_rows(spark, tmp_path):
    folder, t = str(tmp_path / "in"), dt.datetime(2026, 5, 1)
    event_files(spark, folder, [[("a", t + dt.timedelta(days=d)) for d in range(12)]])
    schema = spark.read.parquet(folder).schema
    counts = jobs.sliding_term_counts(jobs.file_stream(spark, folder, schema), "ts", "k", 7, "1 day")
    jobs.append_to(counts, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    rows = {str(r["window_start"]): r["occurrences"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["2026-05-01"] == 7 and rows["2026-04-25"] == 1 and "2026-05-06" not in rows


def test_failed_sources_are_found(spark, tmp_path):
    sources = spark.createDataFrame(
        [(s, s, 1, t, "", 0.8, e) for s, t, e in [
            ("fine", "rss", True), ("cut", "rss", True), ("page", "rss", True), ("empty", "atom", True), ("none", "atom", True),
            ("good", "hn_api", True), ("bad", "hn_api", True), ("off", "rss", False), ("odd", "gopher", True)]],
        "id string, name string, tier int, type string, url string, confidence double, enabled boolean")
    files = {
        "rss/source_id=fine/a.xml": "<rss>\n<channel>\n<item><title>T &amp; t</title><link>https://e.com/1</link></item>\n</channel></rss>\n",
        "rss/source_id=cut/a.xml": "<rss><channel><item><title>T</title><link>https://e.com/2</link></item><item><tit",
        "rss/source_id=cut/b.xml": "<rss><channel></channel></rss>",
        "rss/source_id=page/a.xml": "<html><body>Not found</body></html>",
        "rss/source_id=off/a.xml": "<rss",
        "atom/source_id=empty/a.xml": " ",
        "hn_api/source_id=good/a.json": '{"id": 1, "type": "story", "title": "an LLM", "time": 1778544000, "rank": 1}\n\n',
        "hn_api/source_id=bad/a.json": '{"id": 2, "type": "story", "title": "an LLM", "rank": 1}\n{"id": 3, "ty\nalso bad\n',
    }
    for name, text in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    cache = spark.createDataFrame([(s, f"https://cache/{s}") for s in ("fine", "cut", "bad", "odd")], "source_id string, url string")
    rows, failures = landed.scanned_or_cached(spark, str(tmp_path), sources, cache, CFG, instant(NOW))
    assert sorted(tuple(r) for r in failures.collect()) == [
        ("bad", "broken record", 2), ("cut", "broken feed file", 1), ("empty", "empty file", 1), ("none", "nothing landed", 1), ("page", "not a feed", 1)]
    assert sorted((r["source_id"], r["from_cache"]) for r in rows.collect()) == [("bad", True), ("cut", True), ("fine", False), ("good", False)]
    nothing = landed.scan_failures(spark, str(tmp_path / "void"), sources)
    assert {r["source_id"]: r["reason"] for r in nothing.collect()} == dict.fromkeys(
        ["fine", "cut", "page", "empty", "none", "good", "bad"], "nothing landed")
