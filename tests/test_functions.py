import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressmill.functions import rules, scoring, text, times, urls, vectors
from pressmill.params import Settings


def one(spark, value, kind, build):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("url, canonical", [
    ("https://example.com/a?utm_source=foo#x", "https://example.com/a"),
    ("  https://e.com/a/?utm_x=1&id=2 ", "https://e.com/a/?id=2"),
    ("https://e.com/a?id=1&fbclid=z&gclid=q", "https://e.com/a?id=1"),
    ("https://e.com/a///", "https://e.com/a"),
    ("https://e.com/a?", "https://e.com/a?"),
    ("https://e.com/a?x?y", "https://e.com/a?x?y"),
    ("", ""),
])
def test_canonical_url(spark, url, canonical):
    assert one(spark, url, "string", urls.canonical_url) == canonical


def test_rules_for_keys_differ(spark):
    assert one(spark, "https://e.com/a?id=1&utm_x=1", "string", urls.legacy_url) == "https://e.com/a?id=1&utm_x=1"
    assert one(spark, "https://e.com/a?utm_x=1&id=2", "string", urls.legacy_url) == "https://e.com/a"


def test_supplied_key_wins(spark):
    row = spark.createDataFrame([("https://e.com/a", "k1"), ("https://e.com/a", "")], "u string, h string").select(
        urls.url_key(F.col("u"), F.col("h")).alias("k")).collect()
    assert row[0]["k"] == "k1" and len(row[1]["k"]) == 16


@pytest.mark.parametrize("url, host", [
    ("https://User@Ex.com:80/a", "user@ex.com:80"), ("no scheme", ""), ("//a.b/c", "a.b"), ("https://a.b?x", "a.b")])
def test_host(spark, url, host):
    assert one(spark, url, "string", urls.host) == host


def test_whitespace(spark):
    assert one(spark, "  hello   world  ", "string", text.squeeze) == "hello world"
    assert one(spark, "　a \n\tb\x1fc ", "string", text.squeeze) == "a b c"
    assert one(spark, None, "string", text.squeeze) == ""


def test_terms(spark):
    df = spark.createDataFrame([("GPT-5 and the Agents 開源模型 今天 AI to x-y 一",)], "s string")
    found = [r["term"] for r in text.exploded_terms(df, [], F.col("s")).collect()]
    assert found == ["gpt-", "agents", "開源模型", "x-y"]


def test_html(spark):
    page = "<p>a &amp; b<br>c</p><script>no()</script><!-- x --><style>n</style><b> d </b>e"
    assert one(spark, page, "string", text.html_text) == "a & b c d e"
    assert one(spark, None, "string", text.html_text) == ""


@pytest.mark.parametrize("s, n", [("", 1), ("abcdef", 2), ("abcdefgh", 2)])
def test_token_cost(spark, s, n):
    assert one(spark, s, "string", text.token_cost) == n


@pytest.mark.parametrize("s, k", [
    ('x {"k": 4} y', 4), ('{"k": 4', -1), ("none", -1), (None, -1), ('{"k": 1} and {"k": 2}', -1), ("{}", None)])
def test_embedded_json(spark, s, k):
    got = one(spark, s, "string", lambda c: text.embedded_json(c, "k INT", F.struct(F.lit(-1).alias("k"))))
    assert got["k"] == k


@pytest.mark.parametrize("s, ok", [
    ("2026-05-12T00:00:00Z", 0), ("2026-05-12T08:00:00+08:00", 0), ("junk", None), ("", None), (None, None)])
def test_parse_iso(spark, s, ok):
    got = one(spark, s, "string", lambda c: F.unix_seconds(times.parse_iso(c)))
    assert got == (None if ok is None else 1778544000 + ok)


def test_feed_dates(spark):
    def sec(s):
        return one(spark, s, "string", lambda c: F.unix_seconds(times.parse_feed_date(c)))
    assert sec("Tue, 12 May 2026 00:00:00 GMT") == 1778544000
    assert sec("12 May 2026 02:00:00 +0200") == 1778544000
    assert sec("2026-05-12T00:00:00Z") == 1778544000
    assert sec("soon") is None


def test_scores(spark):
    as_of = times.instant(dt.datetime(2026, 5, 12))

    def nov(hours):
        when = None if hours is None else dt.datetime(2026, 5, 12) - dt.timedelta(hours=hours)
        return one(spark, when, "timestamp", lambda c: scoring.novelty(c, as_of))
    assert [nov(h) for h in (None, -5, 0, 36, 96, 200)] == [6.0, 10.0, 10.0, 6.25, 0.0, 0.0]
    assert one(spark, "gpt-5 CLAUDE", "string", lambda c: scoring.hits(F.lower(c), ["GPT-5", "Claude", "x"])) == 2
    assert one(spark, "a" * 200, "string", lambda c: scoring.impact(c, F.lit(1))) == 7.5
    assert one(spark, "a" * 1501, "string", lambda c: scoring.impact(c, F.lit(9))) == 10.0
    assert one(spark, 9, "int", lambda c: scoring.tier_factor(c, Settings().tier_bonus)) == 1.0
    assert one(spark, 0, "int", lambda c: scoring.tier_factor(c, {2: 3.0})) == 3.0
    assert one(spark, None, "int", lambda c: scoring.tier_factor(c, {2: 3.0})) == 3.0


def test_rules(spark):
    table = [("sea", ["boat", "tide"]), ("land", ["hill", "boathouse"])]

    def section(s):
        return one(spark, s, "string", lambda c: rules.first_match(F.lower(c), table, "air"))
    assert section("A HILL by the tide") == "sea"
    assert section("the boathouse") == "sea"  # "boat" is found inside it first
    assert section("hills") == "land"
    assert section("none") == "air" and Settings().section_rules == []
    marks = [("a", "x"), ("b", "y"), ("c", "x"), ("d", "z"), ("e", "v"), ("f", "w"), ("g", "u")]
    assert one(spark, "abcdefg", "string", lambda c: rules.tags(c, marks, "none")) == ["x", "y", "z", "v", "w"]
    assert one(spark, "zzz", "string", lambda c: rules.tags(c, marks, "none")) == ["none"]
    assert [one(spark, v, "double", rules.band) for v in (0.6, 0.5, -0.2, -0.3)] == ["up", "flat", "flat", "down"]


def test_cosine(spark):
    def cos(u, v):
        return spark.createDataFrame([(u, v)], "u array<double>, v array<double>").select(
            vectors.cosine(F.col("u"), F.col("v")).alias("c")).first()["c"]
    assert cos([1.0, 0.0], [2.0, 0.0]) == pytest.approx(1.0)
    assert cos([1.0], [1.0, 0.0]) == 0 and cos([0.0], [1.0]) == 0 and cos([], []) == 0
    mean = spark.createDataFrame([([1.0, 3.0], [4.0, 0.0])], "m array<double>, v array<double>").select(
        vectors.running_mean(F.col("m"), F.col("v"), F.lit(3)).alias("x")).first()["x"]
    assert mean == [2.0, 2.0]
