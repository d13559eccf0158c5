import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pressmill.functions.times import instant
from pressmill.operators import budget, edition, expand, keyed, layout, normalize, runs, search, sections, trends
from pressmill.params import Settings

CFG = Settings()


def test_normalize_and_rejects(spark):
    rows = [
        (1, " https://e.com/a?utm_source=f#x ", None, " hi  there ", None, "s", None, None, "2026-05-12T00:00:00Z", None),
        (2, " ", None, "t", "d", "s", "S", "0.8", None, None),
        (3, "https://e.com/b", "given", "t", "d", None, "S", "0.8", None, None),
        (4, "https://e.com/c", "given", "t", "d", "s", "S", "high", "junk", None),
        (5, "https://e.com/d", "given", None, "d", "s", "S", "0.8", "junk", "2026-05-11T00:00:00Z"),
    ]
    raw = spark.createDataFrame(rows, "n int, url string, url_hash string, title string, description string, "
                                "source_id string, source_name string, source_confidence string, published_at string, fetched_at string")
    good = {r["n"]: r for r in normalize.normalize(raw, instant("2026-05-13")).collect()}
    assert sorted(good) == [1, 5]
    assert good[1]["url"] == "https://e.com/a" and good[1]["title"] == "hi there" and good[1]["description"] == ""
    assert good[1]["source_name"] == "s" and good[1]["source_confidence"] == 0.7 and len(good[1]["url_hash"]) == 16
    assert good[5]["published_at"] is None and good[5]["url_hash"] == "given"
    assert {r["n"]: r["reject_reason"] for r in normalize.rejects(raw).collect()} == {
        2: "missing url", 3: "missing source_id", 4: "bad source_confidence"}


def test_keyed(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4), ("c", 5)], "url_hash string, arrival long")
    stored = spark.createDataFrame([("c",)], "url_hash string")
    assert sorted(map(tuple, keyed.new_articles(df, stored).collect())) == [("a", 1), ("b", 3)]
    assert tuple(keyed.keyed_drop_counts(df, stored).first()) == (2, 1)
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, v int, p string")
    new = spark.createDataFrame([("a", 1, "n"), ("b", 4, "n"), ("d", 1, "n")], old.schema)
    assert sorted(map(tuple, keyed.upserted(old, new, ["k"], "v").collect())) == [("a", 1, "n"), ("b", 5, "y"), ("d", 1, "n")]
    assert [r["k"] for r in keyed.ignored_if_present(old, new, ["k"], [F.col("v")]).collect()] == ["d"]
    # without a version the later write wins, whatever its values are
    assert sorted(map(tuple, keyed.upserted(old, new, ["k"], None).collect())) == [("a", 1, "n"), ("b", 4, "n"), ("d", 1, "n")]


def test_window_group_limit_is_used(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keyed.top_per_key(df, ["k"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_running_sum_both_ways(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), i, rng.randint(1, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, at int, v int")
    want, total = {}, {}
    for g, at, v in rows:
        total[g] = total.get(g, 0) + v
        want[g, at] = total[g]
    for limit in (1000, 10):
        got = layout.running_sum(df, ["g"], ["at"], F.col("v"), "run", group_limit=limit, chunks=5).collect()
        assert {(r["g"], r["at"]): r["run"] for r in got} == want


def admit_loop(rows, daily, monthly):
    used_day, used_month, out = {}, {}, {}
    for month, day, at, tokens in sorted(rows):
        d, m = used_day.get((month, day), 0), used_month.get(month, 0)
        ok = (not daily or d + tokens <= daily) and (not monthly or m + tokens <= monthly)
        if ok:
            used_day[month, day], used_month[month] = d + tokens, m + tokens
        out[month, day, at] = ok
    return out


@pytest.mark.parametrize("daily, monthly, limit", [
    (None, None, 100), (100, None, 10_000), (100, None, 3), (None, 300, 3), (120, 300, 10_000), (120, 300, 3), (57, 111, 1)])
def test_budget_admission(spark, daily, monthly, limit):
    rng = random.Random(limit + (daily or 0))
    rows = [(rng.choice(["m1", "m2"]), rng.choice([1, 1, 1, 2, 3]), i, rng.choice([1, 2, 3, 10, 40, 90, 200])) for i in range(220)]
    df = spark.createDataFrame(rows, "month string, day int, at int, tokens long")
    got = budget.admitted(df, ["at"], daily, monthly, group_limit=limit, chunks=4).collect()
    assert {(r["month"], r["day"], r["at"]): r["admitted"] for r in got} == admit_loop(rows, daily, monthly)
    assert len(got) == len(rows)


def article(i, section, score, date="d"):
    return (i, section, float(score), date)


def test_sections_and_backfill(spark):
    rows = [article(i, "giants_market", 9 - i * 0.1) for i in range(6)] + [
        article(10, "edu_tech", 8.0), article(11, "unknown", 9.5), article(12, "edu_tech", 8.0)]
    df = spark.createDataFrame(rows, "arrival long, section string, final_score double, date string")
    for by in ([], ["date"]):
        got = {}
        for r in sections.placed(df, CFG, by).collect():
            got.setdefault(r["placed_section"], []).append((r["slot"], r["arrival"], r["backfilled"]))
        assert sorted(got["giants_market"]) == [(1, 11, False), (2, 0, False), (3, 1, False)]
        assert sorted(got["edu_tech"]) == [(1, 10, False), (2, 12, False)]
        assert sorted(got["dev_tools_agent"]) == [(1, 2, True), (2, 3, True)]
        assert sorted(got["generative_media"]) == [(1, 4, True), (2, 5, True)]
        assert "infra_open_source" not in got


def test_trends(spark):
    as_of = dt.datetime(2024, 2, 1)
    words = ["alpha alpha beta", "alpha gamma", "beta gamma gamma", "alpha", "gamma"]
    ages = [1, 2, 5, 10, 29]
    rows = [(i, f"{w} title", "", ["x"], as_of - dt.timedelta(days=a)) for i, (w, a) in enumerate(zip(words, ages))]
    late = [(9, "alpha alpha alpha", "", ["x"], as_of + dt.timedelta(days=1))]  # after as_of: not counted, not shown
    df = spark.createDataFrame(rows + late, "arrival long, title string, summary string, tags array<string>, ts timestamp").withColumn(
        "description", F.col("summary"))
    history = spark.createDataFrame([(dt.date(2024, 1, 30), 7, "alpha", 2), (dt.date(2024, 1, 29), 7, "alpha", 9),
                                     (dt.date(2024, 2, 1), 7, "alpha", 50)],
                                    "date date, window_days int, keyword string, occurrences long")
    cfg = replace(CFG, trend_min_count=3)
    got = {(r["window_days"], r["keyword"]): r for r in trends.trends(df, history, as_of.date(), instant(as_of), cfg).collect()}
    assert got[7, "alpha"]["occurrences"] == 3 and got[7, "alpha"]["velocity"] == 0.5
    assert got[7, "alpha"]["samples"] == ["alpha alpha beta title", "alpha gamma title"]
    assert got[14, "alpha"]["occurrences"] == 4 and got[14, "alpha"]["velocity"] == 4.0
    assert got[30, "gamma"]["occurrences"] == 4 and (7, "beta") not in got
    bursts = trends.bursts(trends.article_terms(df, ["ts"]), df, instant(as_of),
                           replace(cfg, burst_days=3, burst_baseline_days=90, burst_min_ratio=1.5))
    # alpha: 3 in 2 recent articles, 4 in 5 articles
    assert [(r["keyword"], r["growth_ratio"]) for r in bursts.collect()] == [("alpha", 1.88)]


def test_source_candidates(spark):
    rows = [(i, f"https://{h}/x{i}", f"t{i}") for i, h in enumerate(["new.org", "Known.com", "new.org", "one.org", "new.org"])]
    df = spark.createDataFrame(rows, "arrival long, url string, title string")
    known = spark.createDataFrame([("https://known.com/feed",)], "url string")
    got = expand.source_candidates(df, known).collect()
    assert [tuple(r) for r in got] == [
        ("new.org", "https://new.org/feed", 3, 4.5, "3 articles from new.org in last batch; sample: t0 · t2")]


def edition_row(spark, counts, insight="i"):
    art = "struct<title:string,summary:string,insight:string,importance:string,source_name:string,final_score:double,tags:array<string>,source_url:string,url_hash:string>"
    made, k = [], 0
    for (sid, icon, label), n in zip(CFG.sections, counts):
        arts = []
        for _ in range(n):
            arts.append((f"Title {k}", "sum", insight, "high" if k == 0 else "medium", f"src{k}", 8.0, ["Tag", f"t{k}"], "u", f"h{k}"))
            k += 1
        made.append((sid, icon, label, arts))
    return spark.createDataFrame([(dt.date(2024, 1, 2), made)],
                                 f"date date, sections array<struct<id:string,icon:string,label:string,articles:array<{art}>>>")


def test_evaluation_cards_alerts(spark):
    row = edition.evaluated(edition_row(spark, [3, 1, 0, 0, 1, 1]), CFG).first()
    assert (row["coverage"], row["diversity"], row["quality"], row["insight_rate"]) == (0.167, 1.0, 0.8, 1.0)
    assert row["overall"] == round(1 / 6 * 0.35 + 0.2 + 0.8 * 0.3 + 0.15, 3)
    assert row["warnings"] == ["section coverage below 80%"]
    empty = edition.evaluated(edition_row(spark, [0] * 6), CFG).first()
    assert empty["overall"] == 0 and empty["warnings"] == ["no articles in edition"]
    drops = spark.createDataFrame([(dt.date(2024, 1, 2), 10)], "date date, dropped long")
    assert len(edition.evaluated(edition_row(spark, [3, 0, 0, 0, 0, 0]), CFG, drops).first()["warnings"]) == 3
    assert [r["value"] for r in edition.cards(edition_row(spark, [2, 1, 0, 0, 0, 0])).orderBy("position").collect()] == ["3", "3", "1", "0"]
    days = spark.createDataFrame([
        (1, 5, False, True, ["a", "", None, "b", "c", "d"]), (2, None, True, False, []), (3, 6, True, True, [])],
        "date int, n_articles int, email_ok boolean, publish_ok boolean, errors array<string>")
    fired = {}
    for r in edition.alerts(days, CFG).orderBy("date", "position").collect():
        fired.setdefault(r["date"], []).append(r["message"])
    assert fired == {1: ["Article count below minimum: 5 < 6", "Email delivery failed", "Pipeline errors: a; b; c"],
                     2: ["AI generation failed — no edition produced", "GitHub publish failed"]}


def test_search(spark):
    items = edition.flattened(edition_row(spark, [3, 1, 0, 0, 0, 0]), CFG)
    assert [r["url_hash"] for r in search.search(items, " TITLE ").collect()] == ["h0", "h1", "h2", "h3"]
    assert [r["url_hash"] for r in search.search(items, "t2").collect()] == ["h2"]
    assert search.search(items, "  ").count() == 0
    assert [r["url_hash"] for r in search.facets(items, tag="TAG", section_label=CFG.sections[1][2]).collect()] == ["h3"]
    assert search.facets(items, date="2024-01-02").count() == 4 and search.facets(items, date="2024-01-03").count() == 0
    mark = spark.createDataFrame([("a <B> C++ c++",)], "s string").select(search.highlighted(F.col("s"), "c++").alias("m")).first()["m"]
    assert mark == 'a &lt;B&gt; <mark>C++</mark> <mark>c++</mark>'
    assert [r["section_label"] for r in search.section_labels(items).collect()] == sorted([CFG.sections[0][2], CFG.sections[1][2]])
    assert items.first()["permalink"] == "/archive/2024-01-02/#h0"


def test_runs(spark):
    rows = [("r1", "running", 1, 0), ("r1", "success", 1, 1), ("r2", "running", 3, 0), ("r2", "failed", 3, 1)]
    ledger = spark.createDataFrame(rows, "run_id string, status string, ts int, seq long")
    assert {r["run_id"]: r["status"] for r in runs.current_status(ledger).collect()} == {"r1": "success", "r2": "failed"}
    assert runs.last_success(ledger).first()["run_id"] == "r1"
    cands = spark.createDataFrame([("a", "pending", 1.0), ("b", "done", 9.0), ("c", "pending", 3.0)], "url string, status string, score double")
    assert [r["url"] for r in runs.pending_candidates(cands).collect()] == ["c", "a"]
