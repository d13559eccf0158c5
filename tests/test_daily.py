"""The whole run on a few items of its own; the expected scores come from a plain form of the formulas."""
import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pressmill.operators import posting, runs
from pressmill.operators.edition import edition_index
from pressmill.params import HIGH_IMPACT, MARKET_SIGNAL, POLICY_KEYWORDS, TAIWAN_RELATED, TIER_BONUS, WEIGHTS, Settings
from pressmill.plans import daily
from pressmill.sources import landed, tables

AS_OF = dt.datetime(2025, 3, 8, 18, 0, 0, tzinfo=dt.timezone.utc)
CFG = replace(Settings(), section_rules=[
    ("dev_tools_agent", ["compiler", "debugger"]), ("infra_open_source", ["kernel", "cluster"]), ("law_ethics_society", ["court", "ruling"])],
    tag_rules=[("compiler", "build"), ("court", "law")])

# id, title, description, source, confidence, tier, hours before as_of
ITEMS = [
    (1, "A compiler that caches everything", "Rebuilds became a benchmark of patience; Llama builds too.", "forge", 0.9, 1, 5),
    (2, "Kernel scheduler rewritten", "The cluster benchmark improved by a tenth.", "rack", 0.88, 1, 12),
    (3, "Court ruling on scraped text", "Regulation of data sets is next, says the court; a benchmark case.", "gavel", 0.93, 1, 20),
    (4, "A compiler that caches everything (again)", "Second report of the same.", "echo", 0.9, 1, 3),
    (5, "Gardeners compare notes", "Nothing but soil.", "plot", 0.7, 3, 30),
    (6, "Debugger attaches to sleeping jobs", "Works with Gemini and with Claude sessions.", "forge", 0.9, 1, 40),
    (7, "Rumour of a merger", "It acquires a rival before its IPO.", "bourse", 0.55, 2, 2),
    (8, "Quiet week", "Long silence.", "rack", 0.95, 1, 200),
]


def expected(item):
    """Final score and whether it may be published."""
    _, title, text, _, confidence, tier, hours = item
    hay = f"{title} {text}".lower()

    def hits(keywords):
        return sum(k.lower() in hay for k in keywords)

    axes = {
        "relevance": min(10, confidence * 10 + min(1.5 * hits(HIGH_IMPACT), 3)),
        "novelty": round(10 * max(0, 1 - hours / 96), 2),
        "impact": min(10, 5 + 1.5 * hits(HIGH_IMPACT)),
        "taiwan_related": min(10, 3 * hits(TAIWAN_RELATED)),
        "market_signal": min(10, 3 * hits(MARKET_SIGNAL)),
    }
    score = round(sum(WEIGHTS[k] * v for k, v in axes.items()) * TIER_BONUS[tier], 3)
    score = round(score + 0.5, 3) if hits(POLICY_KEYWORDS) else score
    return score, score >= CFG.final_score_min and confidence >= CFG.confidence_min


GOOD = {i[0]: expected(i)[0] for i in ITEMS if i[0] != 4 and expected(i)[1]}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    landing = root / "raw.json"
    landing.write_text(json.dumps([{
        "url": f"https://site{i}.org/{i}?utm_source=a#b", "url_hash": f"h{i:02d}", "title": f" {title} ",
        "description": text, "source_id": source, "source_name": source.upper(), "source_confidence": conf, "tier": tier,
        "published_at": (AS_OF - dt.timedelta(hours=hours)).isoformat(), "fetched_at": (AS_OF - dt.timedelta(hours=1)).isoformat(),
    } for i, title, text, source, conf, tier, hours in ITEMS] + [{"title": "missing url"}], ensure_ascii=False))
    paths = daily.Paths(str(root / "state"))
    answers = spark.createDataFrame([(f"h{i[0]:02d}", "noted") for i in ITEMS], "url_hash string, insight string")
    vectors = spark.createDataFrame(
        [(f"h{i[0]:02d}", [1.0 if k == i[0] else 0.0 for k in range(9)]) for i in ITEMS], "url_hash string, vector array<double>")
    raw = landed.numbered(landed.raw_items(spark, str(landing)), ["url_hash"])
    edition = daily.process(spark, raw, paths, AS_OF, CFG, answers=answers, vectors=vectors).first()
    return paths, raw, answers, vectors, edition


def test_items_are_of_both_kinds():
    assert set(GOOD) == {1, 2, 3, 6} and 4 not in GOOD


def test_sections_and_scores(run):
    articles = {int(a["url_hash"][1:]): (s["id"], a) for s in run[-1]["sections"] for a in s["articles"]}
    assert {i: a["final_score"] for i, (_, a) in articles.items()} == GOOD
    assert {i: a["section"] for i, (_, a) in articles.items()} == {
        1: "dev_tools_agent", 2: "infra_open_source", 3: "law_ethics_society", 6: "dev_tools_agent"}
    assert articles[3][1]["source_url"] == "https://site3.org/3" and articles[3][1]["tags"] == ["law"]


def test_evaluation(run):
    mark = run[-1]["evaluation"]
    quality = round(sum(GOOD.values()) / len(GOOD) / 10, 3)
    parts = mark["components"].asDict()
    assert parts["quality"] == quality and parts["insight_rate"] == 1.0 and parts["diversity"] == 0.75
    assert run[-1]["dedup"] == {"by_db": 0, "by_url": 0, "by_title": 1, "by_embedding": 0}
    assert [c["value"] for c in run[-1]["dashboard"][:2]] == ["4", "3"]


def test_state_and_second_day(spark, run):
    paths, raw, answers, vectors, _ = run
    assert spark.read.parquet(paths.articles).count() == 4
    assert spark.read.parquet(paths.embeddings).count() == 7
    nxt = daily.process(spark, raw, paths, AS_OF + dt.timedelta(days=1), CFG, answers=answers, vectors=vectors).first()
    assert nxt["dedup"]["by_db"] == 4
    assert spark.read.parquet(paths.archive).count() == 2
    ledger = spark.read.parquet(paths.runs)
    assert sorted(r["status"] for r in ledger.collect()) == ["running", "running", "success", "success"]
    assert {r["status"] for r in runs.current_status(ledger).collect()} == {"success"}
    fired = daily.publish(spark, paths, AS_OF.date()).collect()
    assert [r["message"].split(":")[0] for r in fired] == ["Article count below minimum"]
    assert spark.read.json(paths.search_index).count() == 4
    index = spark.read.json(paths.edition_index)
    assert {(str(r["date"]), r["article_count"]) for r in index.collect()} == {
        (str(r["date"]), r["article_count"]) for r in edition_index(spark.read.parquet(paths.archive)).collect()} and index.count() == 2
    found = posting.search_postings(spark, paths.search_postings, nxt_title(run)[2:9]).collect()
    assert nxt_title(run) in {r["title"] for r in found}
    # all dates are indexed now: publishing one again reads its partition of the archive only
    left = tables.unindexed(spark.read.parquet(paths.archive), spark.read.parquet(paths.archive).where(F.col("date") == F.lit(AS_OF.date())), paths.edition_index)
    assert [r["date"] for r in left.select("date").collect()] == [AS_OF.date()]
    assert "dynamicpruning" in left._jdf.queryExecution().toString()


def nxt_title(run):
    return next(a["title"] for s in run[-1]["sections"] for a in s["articles"])


def test_metrics_equal_counts(spark, run):
    paths, raw, *_ = run
    rows = [r for r in spark.read.parquet(paths.runs).collect() if r["status"] == "success"]
    first = min(rows, key=lambda r: r["run_id"])["metrics"]
    assert first["articles_fetched"] == raw.count() and first["articles_filtered"] == 4
    assert first["dedup_drop_total"] == sum(first[f"dedup_{k}"] for k in ("by_db", "by_url", "by_title", "by_embedding")) == 1
    assert all(first[f"{k}_seconds"] >= 0 for k in ("fetch", "dedup", "score", "elapsed"))


def test_rerun_keeps_what_was_written_last(spark, run, tmp_path):
    _, raw, answers, vectors, _ = run
    paths = daily.Paths(str(tmp_path))
    daily.process(spark, raw, paths, AS_OF, CFG, answers=answers, vectors=vectors)
    before = {(r.window_days, r.keyword): r.occurrences for r in spark.read.parquet(paths.trends).collect()}
    daily.process(spark, raw, paths, AS_OF, CFG, answers=answers, vectors=vectors)
    assert {(r.window_days, r.keyword): r.occurrences for r in spark.read.parquet(paths.trends).collect()} == before and before


def test_publish_without_an_edition_alerts(spark, tmp_path):
    fired = daily.publish(spark, daily.Paths(str(tmp_path)), AS_OF.date()).collect()
    assert len(fired) == 1 and "no edition" in fired[0]["message"]


def test_failed_run_is_recorded(spark, tmp_path):
    paths = daily.Paths(str(tmp_path))
    broken = spark.createDataFrame([("x",)], "nothing string")
    with pytest.raises(Exception):
        daily.process(spark, broken, paths, AS_OF, CFG)
    assert sorted(r["status"] for r in spark.read.parquet(paths.runs).collect()) == ["failed", "running"]


def test_run_without_vectors_or_answers(spark, run, tmp_path):
    paths = daily.Paths(str(tmp_path))
    tables.write_bronze(run[1], paths.bronze)
    edition = daily.process(spark, spark.read.parquet(paths.bronze), paths, AS_OF, CFG).first()
    assert sum(len(s["articles"]) for s in edition["sections"]) == 4
