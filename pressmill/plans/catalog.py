"""Registered queries on the supplied tables, each with its SQL for comparison where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as PA
from ..functions import rules as R
from ..functions import scoring as S
from ..functions import text as X
from ..functions import times as TM
from ..functions import urls as U
from ..functions import vectors as V
from ..operators import budget as B
from ..operators import cluster as CL
from ..operators import edition as ED
from ..operators import keyed as K
from ..operators import moving as MV
from ..operators import posting as PO
from ..operators import runs as RU
from ..operators import search as SE
from ..operators import trends as TR
from ..operators.enrich import classified
from ..operators.expand import source_candidates, unknown_hosts
from ..operators.normalize import normalize, rejects, with_defaults
from ..operators.score import policy_boosted, publishable, scored
from ..operators.sections import placed
from ..operators.title_join import keep_first_titles
from ..operators.vector_join import keep_first_vectors, not_near
from ..params import RELEVANCE_KEYWORDS, STOPWORDS_EN, STOPWORDS_ZH, TIER_BONUS, TIER_FETCH_LIMIT
from ..session import materialize, scratch_path
from ..sources import landed as L
from ..sources import state as ST
from ..sources import tables as T
from ..streaming import ever as EV
from ..streaming import jobs as J
from .corpus import (ARTICLES_SQL, AS_OF_TEXT, CORPUS, LEDGER_SQL, OCCURRENCES_SQL, articles, as_of, headlines, ledger,
                     occurrences, squeeze_sql, table, vectors)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


# ---------------------------------------------------------------- SQL building blocks

def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hits_sql(hay: str, keywords: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({hay}, {lit(k.lower())}) AS INTEGER)" for k in keywords) + ")"


def any_sql(hay: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({hay}, {lit(k.lower())})" for k in keywords) + ")"


def first_match_sql(hay: str, rules, default: str) -> str:
    cases = " ".join(f"WHEN {any_sql(hay, ks)} THEN {lit(label)}" for label, ks in rules)
    return f"CASE {cases} ELSE {lit(default)} END"


CANON_SQL = r"""canon AS (
  SELECT page_id, url, html,
    regexp_replace(CASE WHEN contains(page, '?') THEN
      base || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END
      ELSE page END, '/+$', '') AS canonical
  FROM (SELECT *, list_filter(string_split(substr(page, length(base) + 2), '&'),
      lambda p: NOT regexp_matches(p, '^(utm_|fbclid=|gclid=)')) AS kept
    FROM (SELECT *, split_part(page, '?', 1) AS base
      FROM (SELECT *, split_part(trim(url), '#', 1) AS page FROM pages))))"""

_bonus = " ".join(f"WHEN {t} THEN {b}e0" for t, b in TIER_BONUS.items())
SCORED_SQL = f"""{ARTICLES_SQL}, ax AS (
  SELECT *,
    least(10e0, source_confidence * 10e0 + least(hh * 1.5e0, 3e0)) AS relevance,
    CASE WHEN published_at IS NULL THEN 6e0 ELSE round(greatest(0e0, 1e0 - greatest(0e0,
      (epoch_us(TIMESTAMP '{AS_OF_TEXT}') - epoch_us(published_at)) / 3.6e9) / 96e0) * 10e0, 2) END AS novelty,
    least(10e0, 5e0 + hh * 1.5e0 + CASE WHEN length(description) BETWEEN 200 AND 1500 THEN 1e0 ELSE 0e0 END) AS impact,
    least(10e0, {hits_sql("hay", CORPUS.taiwan_related)} * 3e0) AS taiwan_related,
    least(10e0, {hits_sql("hay", CORPUS.market_signal)} * 3e0) AS market_signal
  FROM (SELECT *, {hits_sql("hay", CORPUS.high_impact)} AS hh
    FROM (SELECT *, lower(title || ' ' || description) AS hay FROM art))
), sc AS (
  SELECT *, round((relevance * 0.3e0 + novelty * 0.2e0 + impact * 0.3e0 + taiwan_related * 0.1e0
    + market_signal * 0.1e0) * CASE tier {_bonus} ELSE 1e0 END, 3) AS final_score
  FROM ax
), bo AS (
  SELECT * REPLACE (CASE WHEN policy_flag THEN round(final_score + {CORPUS.policy_boost}e0, 3)
    ELSE final_score END AS final_score)
  FROM (SELECT *, {any_sql("lower(title || ' ' || description || ' ' || summary)", CORPUS.policy_keywords)} AS policy_flag FROM sc)
), pub AS (
  SELECT * FROM bo WHERE final_score >= {CORPUS.final_score_min}e0 AND source_confidence >= {CORPUS.confidence_min}e0
)"""

_tag_cases = ", ".join(f"CASE WHEN contains(hay2, {lit(k)}) THEN {lit(t)} END" for k, t in CORPUS.tag_rules)
CLASSIFIED_SQL = f"""cl AS (
  SELECT * REPLACE (CASE WHEN len(tags) > 0 THEN tags[1:5] ELSE ['ai'] END AS tags)
  FROM (SELECT *,
    {first_match_sql("hay2", CORPUS.section_rules, CORPUS.default_section)} AS section,
    {first_match_sql("hay2", CORPUS.perspective_rules, CORPUS.default_perspective)} AS perspective,
    list_filter([{_tag_cases}], lambda t: t IS NOT NULL) AS tags
  FROM (SELECT *, lower(title || ' ' || description) AS hay2
    FROM pub)))"""

_positions = ", ".join(f"({i}, {lit(s[0])}, {lit(s[2])})" for i, s in enumerate(CORPUS.sections))
PLACED_SQL = f"""sec(position, id, label) AS (VALUES {_positions}),
rk AS (SELECT *, row_number() OVER (PARTITION BY date, section ORDER BY final_score DESC, arrival) AS rk FROM cl),
picked AS (SELECT * FROM rk WHERE rk <= {CORPUS.per_section_max}),
spare AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY final_score DESC, arrival) AS turn
  FROM rk WHERE rk > {CORPUS.per_section_max}),
need AS (SELECT d.date, sec.position, sec.id, (SELECT count(*) FROM picked p WHERE p.date = d.date AND p.section = sec.id) AS n
  FROM (SELECT DISTINCT date FROM picked) d CROSS JOIN sec),
gaps AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY position, slot) AS turn
  FROM (SELECT date, position, id, unnest(range(n + 1, {CORPUS.per_section_min + 1})) AS slot FROM need)),
placed AS (
  SELECT p.* EXCLUDE (rk), p.section AS placed_section, rk AS slot, false AS backfilled FROM picked p
  UNION ALL
  SELECT s.* EXCLUDE (rk, turn), g.id AS placed_section, g.slot AS slot, true AS backfilled
  FROM spare s JOIN gaps g USING (date, turn))"""

EDITION_SQL = f"""WITH {SCORED_SQL}, {CLASSIFIED_SQL}, {PLACED_SQL}"""


def _published(spark: SparkSession, sf: str) -> DataFrame:
    rows = policy_boosted(scored(articles(spark, sf), CORPUS, as_of()), CORPUS)
    return classified(publishable(rows, CORPUS), CORPUS)


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return placed(_published(spark, sf), CORPUS, ["date"])


def _editions(spark: SparkSession, sf: str) -> DataFrame:
    return ED.nested(_placed(spark, sf), CORPUS)


# ---------------------------------------------------------------- URLs and pages

@query("url_canonical", f"WITH {CANON_SQL} SELECT page_id, canonical FROM canon")
def url_canonical(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.canonical_url(F.col("url")).alias("canonical"))


@query("url_key", f"WITH {CANON_SQL} SELECT page_id, left(sha256(canonical), 16) AS url_hash FROM canon")
def url_key(spark, sf):
    canonical = U.canonical_url(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id", U.url_key(canonical, F.lit(None).cast("string")).alias("url_hash"))


@query("url_legacy_diff", f"""WITH {CANON_SQL}, both_ AS (
  SELECT page_id, canonical, regexp_replace(split_part(split_part(url, '#', 1), '?utm_', 1), '/+$', '') AS legacy FROM canon)
SELECT page_id, canonical, legacy, canonical = legacy AS same FROM both_""")
def url_legacy_diff(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.canonical_url(F.col("url")).alias("canonical"), U.legacy_url(F.col("url")).alias("legacy"),
    ).withColumn("same", F.col("canonical") == F.col("legacy"))


@query("url_dedup_first", f"""WITH {CANON_SQL}
SELECT key, min(page_id) AS page_id FROM (
  SELECT page_id, left(sha256(regexp_replace(canonical, '^https?://(www[.]|m[.]|blog[.])?', '')), 16) AS key FROM canon)
GROUP BY key""")
def url_dedup_first(spark, sf):
    bare = F.regexp_replace(U.canonical_url(F.col("url")), r"^https?://(www[.]|m[.]|blog[.])?", "")
    pages = table(spark, sf, "pages").select("page_id", U.key_of(bare).alias("key"))
    return K.first_per_key(pages, ["key"], [F.col("page_id")])


@query("key_dedup_first", f"""WITH {ARTICLES_SQL}
SELECT url_hash, arrival, title FROM art QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY arrival) = 1""")
def key_dedup_first(spark, sf):
    return K.first_per_key(articles(spark, sf), ["url_hash"], [F.col("arrival")]).select("url_hash", "arrival", "title")


KNOWN_HOSTS = ["https://spam-farm.example.org/feed", "https://www.cheap-pills.example.com/rss",
               "https://ads-track.example.org/rss.xml"]
_known_sql = ", ".join(lit(u.split("/")[2]) for u in KNOWN_HOSTS)
HOSTS_SQL = f"""{CANON_SQL}, strangers AS (
  SELECT *, {squeeze_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title
  FROM (SELECT *, lower(regexp_extract(canonical, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host FROM canon)
  WHERE host <> '' AND host NOT IN ({_known_sql}))"""


def _pages(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("arrival"), U.canonical_url(F.col("url")).alias("url"),
        X.html_title(F.col("html")).alias("title"))


def _known(spark):
    return spark.createDataFrame([(u,) for u in KNOWN_HOSTS], "url string")


@query("host_counts", f"WITH {HOSTS_SQL} SELECT host, count(*) AS n FROM strangers GROUP BY host")
def host_counts(spark, sf):
    return unknown_hosts(_pages(spark, sf), _known(spark)).groupBy("host").agg(F.count(F.lit(1)).alias("n"))


@query("source_candidates", f"""WITH {HOSTS_SQL}, top AS (
  SELECT host, count(*) AS n, min(page_id) AS first FROM strangers GROUP BY host ORDER BY n DESC, first LIMIT 10)
SELECT host, 'https://' || host || '/feed' AS url, n, least(10e0, n * 1.5e0) AS score,
  n || {lit(PA.REASON_FROM)} || host || {lit(PA.REASON_SAMPLE)} || (
    SELECT string_agg(title, {lit(PA.REASON_JOIN)} ORDER BY page_id) FROM (
      SELECT title, page_id FROM strangers s WHERE s.host = top.host ORDER BY page_id LIMIT 2)) AS reason
FROM top WHERE n >= 2""")
def source_candidates_(spark, sf):
    return source_candidates(_pages(spark, sf), _known(spark))


@query("page_title", f"""SELECT page_id, {squeeze_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages""")
def page_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.html_title(F.col("html")).alias("title"))


_piece = f"regexp_replace(x, '^{X.WHITESPACE}+|{X.WHITESPACE}+$', '', 'g')"


@query("page_text", f"""SELECT page_id, replace(replace(replace(replace(array_to_string(list_filter(list_transform(
    regexp_split_to_array(regexp_replace(regexp_replace(html, '(?is)<(script|style|template)[^>]*>.*?</(script|style|template)>', '<x>', 'g'),
      '(?s)<!--.*?-->', '<x>', 'g'), '<[^>]*>'), lambda x: {_piece}), lambda x: x <> ''), ' '),
  '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&') AS text FROM pages""")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.html_text("html").alias("text"))


# ---------------------------------------------------------------- normalisation

def _raw(spark, sf):
    """Documents as raw items with the gaps and junk that landed input has."""
    doc = F.col("doc_id")
    day = F.date_format(F.date_sub(F.lit("2024-01-30").cast("date"), (doc % 30).cast("int")), "yyyy-MM-dd")
    return table(spark, sf, "documents").select(
        doc,
        F.when(doc % 13 == 0, "  ").otherwise(F.concat(
            F.lit(" https://"), F.col("source"), F.lit(".example.org/a/"), doc.cast("string"),
            F.lit("/?utm_source=x&id="), doc.cast("string"), F.lit("#top"))).alias("url"),
        F.when(doc % 5 == 0, F.concat(F.lit("given"), doc.cast("string"))).otherwise("").alias("url_hash"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(doc % 7 != 0, F.col("text")).alias("description"),
        F.when(doc % 11 != 0, F.col("source")).alias("source_id"),
        F.when(doc % 2 == 0, F.upper("source")).alias("source_name"),
        F.when(doc % 19 == 0, "n/a").when(doc % 3 != 0, "0.85").alias("source_confidence"),
        (doc % 4 + 1).cast("int").alias("tier"),
        F.when(doc % 3 == 0, F.concat(day, F.lit("T10:20:30Z")))
        .when(doc % 3 == 1, F.concat(day, F.lit("T10:20:30+08:00"))).otherwise("yesterday").alias("published_at"),
        F.when(doc % 4 != 0, F.concat(day, F.lit("T23:00:00+00:00"))).alias("fetched_at"))


RAW_SQL = """raw AS (
  SELECT doc_id,
    CASE WHEN doc_id % 13 = 0 THEN '  ' ELSE ' https://' || source || '.example.org/a/' || doc_id || '/?utm_source=x&id=' || doc_id || '#top' END AS url,
    CASE WHEN doc_id % 5 = 0 THEN 'given' || doc_id ELSE '' END AS url_hash,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN doc_id % 7 <> 0 THEN text END AS description,
    CASE WHEN doc_id % 11 <> 0 THEN source END AS source_id,
    CASE WHEN doc_id % 2 = 0 THEN upper(source) END AS source_name,
    CASE WHEN doc_id % 19 = 0 THEN 'n/a' WHEN doc_id % 3 <> 0 THEN '0.85' END AS source_confidence,
    CAST(DATE '2024-01-30' - CAST(doc_id % 30 AS INTEGER) AS DATE) AS day
  FROM documents)"""


@query("whitespace_norm", f"""SELECT doc_id, {squeeze_sql("text")} AS text FROM documents""")
def whitespace_norm(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.squeeze(F.col("text")).alias("text"))


@query("null_defaults", f"""WITH {RAW_SQL}
SELECT doc_id, coalesce(source_name, source_id) AS source_name,
  CASE WHEN source_confidence IS NULL THEN 0.7e0 ELSE TRY_CAST(source_confidence AS DOUBLE) END AS source_confidence,
  {squeeze_sql("description")} AS description FROM raw""")
def null_defaults(spark, sf):
    return with_defaults(_raw(spark, sf)).select("doc_id", "source_name", "source_confidence", "description")


@query("reject_rows", f"""WITH {RAW_SQL}
SELECT doc_id, CASE WHEN trim(url) = '' THEN 'missing url' WHEN source_id IS NULL THEN 'missing source_id'
  ELSE 'bad source_confidence' END AS reject_reason
FROM raw WHERE trim(url) = '' OR source_id IS NULL OR (source_confidence IS NOT NULL AND TRY_CAST(source_confidence AS DOUBLE) IS NULL)""")
def reject_rows(spark, sf):
    return rejects(_raw(spark, sf)).select("doc_id", "reject_reason")


@query("normalized_articles", f"""WITH {RAW_SQL}, ok AS (
  SELECT *, 'https://' || regexp_extract(url, 'src[0-9]+') || '.example.org/a/' || doc_id || '/?id=' || doc_id AS canonical
  FROM raw WHERE trim(url) <> '' AND source_id IS NOT NULL
    AND (source_confidence IS NULL OR TRY_CAST(source_confidence AS DOUBLE) IS NOT NULL))
SELECT doc_id, canonical AS url, CASE WHEN url_hash <> '' THEN url_hash ELSE left(sha256(canonical), 16) END AS url_hash,
  CASE doc_id % 3 WHEN 0 THEN epoch_us(day + INTERVAL '10:20:30' HOUR TO SECOND) // 1000000
    WHEN 1 THEN epoch_us(day + INTERVAL '02:20:30' HOUR TO SECOND) // 1000000 END AS published_sec,
  CASE WHEN doc_id % 4 <> 0 THEN epoch_us(day + INTERVAL '23:00:00' HOUR TO SECOND) // 1000000
    ELSE epoch_us(TIMESTAMP '{AS_OF_TEXT}') // 1000000 END AS fetched_sec
FROM ok""".replace("INTERVAL '10:20:30' HOUR TO SECOND", "to_seconds(37230)")
       .replace("INTERVAL '02:20:30' HOUR TO SECOND", "to_seconds(8430)")
       .replace("INTERVAL '23:00:00' HOUR TO SECOND", "to_seconds(82800)"))
def normalized_articles(spark, sf):
    return normalize(_raw(spark, sf), as_of()).select(
        "doc_id", "url", "url_hash", F.unix_seconds("published_at").alias("published_sec"),
        F.unix_seconds("fetched_at").alias("fetched_sec"))


@query("feed_dates", """SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN epoch_us(day + to_seconds(37230)) // 1000000 WHEN 1 THEN epoch_us(day + to_seconds(37230)) // 1000000
    WHEN 2 THEN epoch_us(day + to_seconds(29)) // 1000000 - 7200 END AS sec
FROM (SELECT doc_id, CAST(DATE '2024-01-30' - CAST(doc_id % 30 AS INTEGER) AS DATE) AS day FROM documents)""")
def feed_dates(spark, sf):
    doc = F.col("doc_id")
    day = F.date_sub(F.lit("2024-01-30").cast("date"), (doc % 30).cast("int"))
    text = (
        F.when(doc % 4 == 0, F.concat(F.date_format(day, "EEE, d MMM yyyy"), F.lit(" 10:20:30 GMT")))
        .when(doc % 4 == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:20:30Z")))
        .when(doc % 4 == 2, F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 00:00:29 +0200")))
        .otherwise("no date"))
    return table(spark, sf, "documents").select("doc_id", F.unix_seconds(TM.parse_feed_date(text)).alias("sec"))


# ---------------------------------------------------------------- scores and rules

@query("relevance_filter", f"""SELECT doc_id, source FROM documents WHERE {any_sql("lower(text)", RELEVANCE_KEYWORDS)}""")
def relevance_filter(spark, sf):
    return table(spark, sf, "documents").filter(S.any_of(F.lower("text"), RELEVANCE_KEYWORDS)).select("doc_id", "source")


@query("score_axes", f"WITH {SCORED_SQL} SELECT arrival, relevance, novelty, impact, taiwan_related, market_signal FROM ax")
def score_axes(spark, sf):
    return scored(articles(spark, sf), CORPUS, as_of()).select("arrival", *S.AXES)


@query("final_score", f"WITH {SCORED_SQL} SELECT arrival, final_score FROM sc")
def final_score(spark, sf):
    return scored(articles(spark, sf), CORPUS, as_of()).select("arrival", "final_score")


@query("policy_boost", f"WITH {SCORED_SQL} SELECT arrival, policy_flag, final_score FROM bo")
def policy_boost(spark, sf):
    return policy_boosted(scored(articles(spark, sf), CORPUS, as_of()), CORPUS).select("arrival", "policy_flag", "final_score")


@query("publishable", f"WITH {SCORED_SQL} SELECT arrival, source_id, final_score FROM pub")
def publishable_(spark, sf):
    rows = policy_boosted(scored(articles(spark, sf), CORPUS, as_of()), CORPUS)
    return publishable(rows, CORPUS).select("arrival", "source_id", "final_score")


_ALL = CLASSIFIED_SQL.replace("FROM pub", "FROM art")


@query("section_rules", f"WITH {ARTICLES_SQL}, {_ALL} SELECT arrival, section FROM cl")
def section_rules(spark, sf):
    return classified(articles(spark, sf), CORPUS).select("arrival", "section")


@query("perspective_rules", f"WITH {ARTICLES_SQL}, {_ALL} SELECT arrival, perspective FROM cl")
def perspective_rules(spark, sf):
    return classified(articles(spark, sf), CORPUS).select("arrival", "perspective")


@query("keyword_tags", f"WITH {ARTICLES_SQL}, {_ALL} SELECT arrival, array_to_string(tags, ',') AS tags FROM cl")
def keyword_tags(spark, sf):
    return classified(articles(spark, sf), CORPUS).select("arrival", F.array_join("tags", ",").alias("tags"))


_limits = " ".join(f"WHEN {t} THEN {n}" for t, n in TIER_FETCH_LIMIT.items())


@query("source_limit", f"""WITH {ARTICLES_SQL}
SELECT source_id, arrival, st AS tier FROM (SELECT *, CAST(substr(source_id, 4) AS INTEGER) % 5 AS st FROM art)
QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY arrival) <= CASE st {_limits} ELSE 20 END""")
def source_limit(spark, sf):
    rows = articles(spark, sf).withColumn("tier", F.substr("source_id", F.lit(4)).cast("int") % 5)
    return L.limited(rows, CORPUS, [F.col("arrival")]).select("source_id", "arrival", "tier")


# ---------------------------------------------------------------- sections and editions

_top3 = PLACED_SQL[:PLACED_SQL.index(",\nspare")]


@query("section_top3", f"""WITH {SCORED_SQL}, {CLASSIFIED_SQL}, {_top3}
SELECT CAST(date AS VARCHAR) AS date, section, rk AS slot, arrival, final_score FROM picked""")
def section_top3(spark, sf):
    best = K.top_per_key(_published(spark, sf), ["date", "section"], [F.col("final_score").desc(), F.col("arrival")],
                         CORPUS.per_section_max, "slot")
    return best.select(F.col("date").cast("string").alias("date"), "section", F.col("slot").cast("long").alias("slot"),
                       "arrival", "final_score")


@query("section_backfill", f"""{EDITION_SQL}
SELECT CAST(date AS VARCHAR) AS date, placed_section, slot, section, arrival, backfilled FROM placed""")
def section_backfill(spark, sf):
    return _placed(spark, sf).select(
        F.col("date").cast("string").alias("date"), "placed_section", "slot", "section", "arrival", "backfilled")


DAILY_SQL = EDITION_SQL.replace("FROM art)", """FROM (SELECT * FROM art QUALIFY row_number() OVER (
      PARTITION BY url_hash ORDER BY arrival) = 1))""", 1)


@query("daily_editions", f"""{DAILY_SQL}
SELECT CAST(date AS VARCHAR) AS date, placed_section, slot, url_hash, final_score, backfilled FROM placed""")
def daily_editions(spark, sf):
    """The daily run on all documents: first copy of each text, scores, filter, rules, quotas."""
    single = K.first_per_key(articles(spark, sf), ["url_hash"], [F.col("arrival")])
    rows = publishable(policy_boosted(scored(single, CORPUS, as_of()), CORPUS), CORPUS)
    return placed(classified(rows, CORPUS), CORPUS, ["date"]).select(
        F.col("date").cast("string").alias("date"), "placed_section", "slot", "url_hash", "final_score", "backfilled")


DROPS_SQL = """drops AS (SELECT date, sum(n - 1) AS dropped FROM (
  SELECT date, url_hash, count(*) AS n FROM art GROUP BY date, url_hash) GROUP BY date)"""
EVAL_SQL = f"""{EDITION_SQL}, {DROPS_SQL}, parts AS (
  SELECT date, count(*) AS n, count(DISTINCT source_name) AS sources, avg(final_score) AS mean,
    avg(CASE WHEN insight <> '' THEN 1e0 ELSE 0e0 END) AS insight_rate,
    (SELECT count(*) FROM (SELECT placed_section FROM placed q WHERE q.date = p.date GROUP BY placed_section
      HAVING count(*) >= {CORPUS.per_section_min})) / {len(CORPUS.sections)}e0 AS coverage
  FROM placed p GROUP BY date
), ev AS (
  SELECT date, n, coverage, least(1e0, sources / greatest(4e0, n / 2e0)) AS diversity, mean / 10e0 AS quality,
    insight_rate, coalesce(dropped, 0) AS dropped FROM parts LEFT JOIN drops USING (date))"""


def _drops(spark, sf):
    per_key = articles(spark, sf).groupBy("date", "url_hash").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("date").agg(F.sum(F.col("n") - 1).alias("dropped"))


@query("edition_eval", f"""{EVAL_SQL}
SELECT CAST(date AS VARCHAR) AS date, n AS n_articles, round(coverage, 3) AS coverage, round(diversity, 3) AS diversity,
  round(quality, 3) AS quality, round(insight_rate, 3) AS insight_rate,
  round(coverage * 0.35e0 + diversity * 0.2e0 + quality * 0.3e0 + insight_rate * 0.15e0, 3) AS overall FROM ev""")
def edition_eval(spark, sf):
    return ED.evaluated(_editions(spark, sf), CORPUS).select(
        F.col("date").cast("string").alias("date"), F.col("n_articles").cast("long").alias("n_articles"), "coverage",
        "diversity", "quality", "insight_rate", "overall")


@query("eval_warnings", f"""{EVAL_SQL}
SELECT CAST(date AS VARCHAR) AS date, array_to_string(list_filter([
  CASE WHEN coverage < 0.8e0 THEN {lit(PA.WARN_COVERAGE)} END,
  CASE WHEN n < {CORPUS.min_articles} THEN {lit(PA.WARN_FEW)} END,
  CASE WHEN dropped > n * 3 THEN {lit(PA.WARN_DROPS)} END], lambda w: w IS NOT NULL), '; ') AS warnings
FROM ev""")
def eval_warnings(spark, sf):
    return ED.evaluated(_editions(spark, sf), CORPUS, _drops(spark, sf)).select(
        F.col("date").cast("string").alias("date"), F.array_join("warnings", "; ").alias("warnings"))


@query("dashboard", f"""{EDITION_SQL}, per_day AS (
  SELECT date, count(*) AS a, count(DISTINCT source_name) AS b,
    count(*) FILTER (WHERE importance IN ('high', 'critical')) AS c FROM placed GROUP BY date)
SELECT CAST(date AS VARCHAR) AS date, label, CAST(value AS VARCHAR) AS value FROM (
  SELECT date, {lit(PA.CARD_ARTICLES)} AS label, a AS value FROM per_day UNION ALL SELECT date, {lit(PA.CARD_SOURCES)}, b FROM per_day
  UNION ALL SELECT date, {lit(PA.CARD_IMPACT)}, c FROM per_day UNION ALL SELECT date, {lit(PA.CARD_TRENDS)}, 0 FROM per_day)""")
def dashboard(spark, sf):
    return ED.cards(_editions(spark, sf)).select(F.col("date").cast("string").alias("date"), "label", "value")


@query("alert_rows", f"""{EDITION_SQL}, days AS (
  SELECT date, day(date) AS d, CASE WHEN day(date) % 7 <> 0 THEN count(*) END AS n FROM placed GROUP BY date)
SELECT CAST(date AS VARCHAR) AS date, message FROM (
  SELECT date, CASE WHEN n IS NULL THEN {lit(PA.ALERT_NO_EDITION)} END AS message FROM days
  UNION ALL SELECT date, CASE WHEN n < {CORPUS.min_articles} THEN {lit(PA.ALERT_FEW)} || n || ' < {CORPUS.min_articles}' END FROM days
  UNION ALL SELECT date, CASE WHEN d % 4 = 0 THEN {lit(PA.ALERT_MAIL)} END FROM days
  UNION ALL SELECT date, CASE WHEN d % 5 = 0 THEN {lit(PA.ALERT_PUBLISH)} END FROM days
  UNION ALL SELECT date, CASE WHEN d % 6 = 0 THEN {lit(PA.ALERT_ERRORS)} || 'e1; e2; e3' END FROM days) WHERE message IS NOT NULL""")
def alert_rows(spark, sf):
    d = F.day("date")
    days = _editions(spark, sf).select(
        "date", F.when(d % 7 != 0, ED.n_articles()).alias("n_articles"), (d % 4 != 0).alias("email_ok"),
        (d % 5 != 0).alias("publish_ok"),
        F.when(d % 6 == 0, F.array(*[F.lit(e) for e in ("e1", "", "e2", "e3", "e4")]))
        .otherwise(F.array().cast("array<string>")).alias("errors"))
    return ED.alerts(days, CORPUS).select(F.col("date").cast("string").alias("date"), "message")


@query("edition_index", f"""{EDITION_SQL}
SELECT CAST(date AS VARCHAR) AS date, count(*) AS article_count FROM placed GROUP BY date""")
def edition_index(spark, sf):
    return ED.edition_index(_editions(spark, sf)).select(
        F.col("date").cast("string").alias("date"), F.col("article_count").cast("long").alias("article_count"))


@query("edition_archive", f"""{EDITION_SQL}, index AS (SELECT date, count(*) AS article_count FROM placed GROUP BY date),
listed AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS position FROM index)
SELECT CAST(date AS VARCHAR) AS date, article_count, CAST(position AS INT) AS position,
  position BETWEEN {CORPUS.editions_front[0]} AND {CORPUS.editions_front[1]} AS on_front FROM listed WHERE position <= {CORPUS.editions_listed}""")
def edition_archive(spark, sf):
    """The editions an archive page lists, and which the front page shows."""
    return ED.listed(ED.edition_index(_editions(spark, sf)), CORPUS).select(
        F.col("date").cast("string").alias("date"), F.col("article_count").cast("long").alias("article_count"), "position", "on_front")


@query("edition_reads", f"""{EDITION_SQL}
SELECT CASE WHEN date = (SELECT max(date) FROM placed) THEN 'latest' ELSE 'by date' END AS asked, CAST(date AS VARCHAR) AS date,
  count(*) AS article_count FROM placed WHERE date IN ((SELECT min(date) FROM placed), (SELECT max(date) FROM placed)) GROUP BY date""")
def edition_reads(spark, sf):
    """Written editions read by date and the latest one."""
    path = scratch_path(spark, "archive")
    T.write_edition(_editions(spark, sf), path)
    archive = spark.read.parquet(path)
    first = archive.agg(F.min("date")).first()[0]
    found = ST.edition_of(archive, first).withColumn("asked", F.lit("by date")).unionByName(
        ST.latest_edition(archive).withColumn("asked", F.lit("latest")))
    return found.select("asked", F.col("date").cast("string").alias("date"), ED.n_articles().cast("long").alias("article_count"))


FLAT_SQL = f"""{EDITION_SQL}, flat AS (
  SELECT p.date, p.title, p.summary, p.insight, p.tags, p.placed_section AS section, sec.label AS section_label,
    p.url AS source_url, p.source_name, p.url_hash,
    '{CORPUS.permalink_prefix}/archive/' || CAST(p.date AS VARCHAR) || '/#' || p.url_hash AS permalink,
    sec.position AS section_position, p.slot
  FROM placed p JOIN sec ON sec.id = p.placed_section)"""


@query("flatten_search_index", f"""{FLAT_SQL}
SELECT CAST(date AS VARCHAR) AS date, title, summary, insight, array_to_string(tags, ',') AS tags, section, section_label,
  source_url, source_name, url_hash, permalink FROM flat""")
def flatten_search_index(spark, sf):
    return ED.flattened(_editions(spark, sf), CORPUS).select(
        F.col("date").cast("string").alias("date"), "title", "summary", "insight", F.array_join("tags", ",").alias("tags"),
        "section", "section_label", "source_url", "source_name", "url_hash", "permalink")


_hay = "lower(title || ' ' || summary || ' ' || insight || ' ' || array_to_string(tags, ' ') || ' ' || section_label)"
_newest = "ORDER BY date DESC, section_position, slot, url_hash"


@query("search_text", f"""{FLAT_SQL}
SELECT CAST(date AS VARCHAR) AS date, section, url_hash, permalink FROM flat WHERE contains({_hay}, 'thin') {_newest} LIMIT 30""")
def search_text(spark, sf):
    return SE.search(ED.flattened(_editions(spark, sf), CORPUS), " Thin ").select(
        F.col("date").cast("string").alias("date"), "section", "url_hash", "permalink")


_SEARCHED = ["thin", "e t", "th", "Q", "thanedble and", "no such text", "  "]
_each = " UNION ALL ".join(f"""SELECT * FROM (SELECT {lit(q)} AS query, CAST(date AS VARCHAR) AS date, section, url_hash, permalink FROM flat
  WHERE trim({lit(q)}) <> '' AND contains({_hay}, lower(trim({lit(q)}))) {_newest} LIMIT 30)""" for q in _SEARCHED)


@query("search_index", f"{FLAT_SQL} {_each}")
def search_index(spark, sf):
    """Searches by trigram index: long, short and common queries, and some without a hit."""
    path = scratch_path(spark, "postings")
    PO.write_postings(ED.flattened(_editions(spark, sf), CORPUS), path)
    found = [PO.search_postings(spark, path, q).select(F.lit(q).alias("query"), F.col("date").cast("string").alias("date"),
                                                        "section", "url_hash", "permalink") for q in _SEARCHED]
    return reduce(DataFrame.unionByName, found)


@query("search_documents", f"""WITH {ARTICLES_SQL}
SELECT arrival, url_hash FROM art WHERE contains(lower(title || ' ' || summary || ' ' || insight || '  '), 'ndha re')""")
def search_documents(spark, sf):
    """The index over every article instead of those of editions; all hits."""
    path = scratch_path(spark, "postings")
    rows = articles(spark, sf).withColumns({"tags": F.array().cast("array<string>"), "section_label": F.lit(None).cast("string")})
    PO.write_postings(rows.select("date", "arrival", "title", "summary", "insight", "tags", "section_label", "url_hash"), path)
    return PO.search_postings(spark, path, "ndha re", limit=2**31 - 1).select("arrival", "url_hash")


@query("facet_filter", f"""{FLAT_SQL}
SELECT CAST(date AS VARCHAR) AS date, section, url_hash FROM flat
WHERE list_contains(tags, 't-ing') AND section_label = {lit(CORPUS.sections[0][2])} {_newest} LIMIT 80""")
def facet_filter(spark, sf):
    return SE.facets(ED.flattened(_editions(spark, sf), CORPUS), tag="T-ING", section_label=CORPUS.sections[0][2]).select(
        F.col("date").cast("string").alias("date"), "section", "url_hash")


_safe = "text"
for _c, _e in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
    _safe = f"replace({_safe}, '{_c}', '{_e}')"


@query("highlight", f"""SELECT doc_id, regexp_replace({_safe}, '(the)', '<mark>\\1</mark>', 'gi') AS text FROM documents""")
def highlight(spark, sf):
    return table(spark, sf, "documents").select("doc_id", SE.highlighted(F.col("text"), "the").alias("text"))


@query("section_labels", f"{FLAT_SQL} SELECT DISTINCT section_label FROM flat")
def section_labels(spark, sf):
    return SE.section_labels(ED.flattened(_editions(spark, sf), CORPUS))


@query("edition_or_latest", f"""{EDITION_SQL}
SELECT CAST(date AS VARCHAR) AS date, count(*) AS article_count FROM placed
WHERE date = (SELECT max(date) FROM placed) GROUP BY date""")
def edition_or_latest(spark, sf):
    chosen = ST.edition_or_latest(_editions(spark, sf), "2024-02-15")
    return chosen.select(F.col("date").cast("string").alias("date"), ED.n_articles().cast("long").alias("article_count"))


# ---------------------------------------------------------------- terms and trends

_upper, _lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_stop = "[" + ", ".join(lit(w) for w in [*STOPWORDS_EN, *STOPWORDS_ZH]) + "]"


def terms_sql(text: str) -> str:
    return (f"list_filter(regexp_extract_all(translate({text}, '{_upper}', '{_lower}'), '{X.TOKEN_PATTERN}'), "
            f"lambda t: (length(t) >= 3 OR regexp_matches(t, '{X.CJK_PATTERN}')) AND NOT list_contains({_stop}, t))")


@query("token_counts", f"""SELECT keyword, count(*) AS n FROM (SELECT unnest({terms_sql("text")}) AS keyword FROM documents) GROUP BY keyword""")
def token_counts(spark, sf):
    return TR.term_counts(X.exploded_terms(table(spark, sf, "documents"), [], F.col("text")))


def windows_sql(as_of_text: str, top: bool = True) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {w} AS window_days, term AS keyword, count(*) AS occurrences FROM occ "
        f"WHERE ts >= TIMESTAMP '{as_of_text}' - INTERVAL {w} DAY AND ts <= TIMESTAMP '{as_of_text}' GROUP BY term"
        for w in CORPUS.trend_windows)
    if not top:
        return parts
    return (f"SELECT * FROM ({parts}) QUALIFY row_number() OVER (PARTITION BY window_days ORDER BY occurrences DESC, keyword) "
            f"<= {CORPUS.trend_top * 3}")


@query("trend_windows", f"""WITH {OCCURRENCES_SQL}
SELECT * FROM ({windows_sql(AS_OF_TEXT)}) WHERE occurrences >= {CORPUS.trend_min_count}""")
def trend_windows(spark, sf):
    counts = TR.window_counts(occurrences(spark, sf), CORPUS.trend_windows, as_of())
    return TR.top_terms(counts, CORPUS).select("window_days", "keyword", "occurrences")


PAST = ("2024-01-24 00:00:00", "2024-01-17 00:00:00")
_history_sql = " UNION ALL ".join(
    f"SELECT DATE '{p[:10]}' AS date, * FROM ({windows_sql(p, top=False)})" for p in PAST)


def _history(spark, sf):
    """Values stored on earlier days."""
    days = []
    for past in PAST:
        then = TM.instant(past)
        days.append(TR.window_counts(occurrences(spark, sf), CORPUS.trend_windows, then).withColumn("date", F.lit(past[:10]).cast("date")))
    return days[0].unionByName(days[1])


@query("trend_velocity", f"""WITH {OCCURRENCES_SQL}, hist AS ({_history_sql}),
top AS (SELECT * FROM ({windows_sql(AS_OF_TEXT)}) WHERE occurrences >= {CORPUS.trend_min_count}),
prev AS (SELECT window_days, keyword, arg_max(occurrences, date) AS prev FROM hist
  WHERE date < DATE '2024-01-31' GROUP BY window_days, keyword),
v AS (SELECT top.*, coalesce(prev, 0) AS prev,
  round(CASE WHEN coalesce(prev, 0) > 0 THEN (occurrences - prev) / prev::DOUBLE ELSE occurrences::DOUBLE END, 3) AS velocity
  FROM top LEFT JOIN prev USING (window_days, keyword))
SELECT *, CASE WHEN velocity > 0.5e0 THEN 'up' WHEN velocity < -0.2e0 THEN 'down' ELSE 'flat' END AS direction FROM v
ORDER BY velocity DESC, occurrences DESC, window_days, keyword LIMIT {CORPUS.trend_top * 3}""")
def trend_velocity(spark, sf):
    top = TR.top_terms(TR.window_counts(occurrences(spark, sf), CORPUS.trend_windows, as_of()), CORPUS)
    previous = TR.previous_values(_history(spark, sf), F.lit("2024-01-31").cast("date"))
    return TR.fastest(TR.with_velocity(top, previous), CORPUS).select(
        "window_days", "keyword", "occurrences", "prev", "velocity", "direction")


INSIDE = ("2024-01-20 00:00:00", "2024-01-21 00:00:00")


def _stored_sql(day: str) -> str:
    return f"SELECT * FROM ({windows_sql(day)}) WHERE occurrences >= {CORPUS.trend_min_count}"


@query("trend_history", f"""WITH {OCCURRENCES_SQL}, first AS ({_stored_sql(INSIDE[0])}), second AS ({_stored_sql(INSIDE[1])}),
rows AS (SELECT DATE '{INSIDE[0][:10]}' AS date, *, 0::BIGINT AS prev FROM first
  UNION ALL SELECT DATE '{INSIDE[1][:10]}', second.*, coalesce(first.occurrences, 0) FROM second LEFT JOIN first USING (window_days, keyword))
SELECT CAST(date AS VARCHAR) AS date, window_days, keyword, occurrences, prev,
  round(CASE WHEN prev > 0 THEN (occurrences - prev) / prev::DOUBLE ELSE occurrences::DOUBLE END, 3) AS velocity FROM rows""")
def trend_history(spark, sf):
    """Two days inside the data: each stores all its recurring top terms, the second moves against the first."""
    path = scratch_path(spark, "history")
    for day in INSIDE:
        now, date = TM.instant(day), F.lit(day[:10]).cast("date")
        top = TR.top_terms(TR.window_counts(occurrences(spark, sf), CORPUS.trend_windows, now), CORPUS)
        stored = T.read(spark, path, "window_days int, keyword string, occurrences bigint, prev bigint, velocity double, date date")
        moved = TR.with_velocity(top, TR.previous_values(stored, date)).withColumn("date", date)
        T.upsert(moved.select("window_days", "keyword", "occurrences", "prev", "velocity", "date"), path,
                 ["date", "window_days", "keyword"], partition="date")
    return spark.read.parquet(path).select(
        F.col("date").cast("string").alias("date"), "window_days", "keyword", "occurrences", "prev", "velocity")


_term_text = "(title || ' ' || description || ' ' || array_to_string(tags, ' '))"


@query("trend_samples", f"""WITH {ARTICLES_SQL}, {_ALL},
occ AS (SELECT fetched_at AS ts, unnest({terms_sql(_term_text)}) AS term FROM cl),
top AS ({windows_sql(AS_OF_TEXT)}),
found AS (SELECT window_days, keyword, title, row_number() OVER (
    PARTITION BY window_days, keyword ORDER BY fetched_at DESC, arrival) AS rn
  FROM top JOIN cl ON contains(lower(title), lower(keyword))
    AND fetched_at >= TIMESTAMP '{AS_OF_TEXT}' - to_days(window_days) AND fetched_at <= TIMESTAMP '{AS_OF_TEXT}')
SELECT window_days, keyword, string_agg(title, ' | ' ORDER BY rn) AS samples FROM found WHERE rn <= 3
GROUP BY window_days, keyword""")
def trend_samples(spark, sf):
    rows = classified(articles(spark, sf), CORPUS).withColumn("ts", F.col("fetched_at"))
    top = TR.top_terms(TR.window_counts(TR.article_terms(rows, ["ts"]), CORPUS.trend_windows, as_of()), CORPUS)
    return TR.sample_titles(rows, top, as_of(), CORPUS.trend_windows).select(
        "window_days", "keyword", F.array_join("samples", " | ").alias("samples"))


@query("shown_trends", f"""WITH {ARTICLES_SQL}, {_ALL},
occ AS (SELECT fetched_at AS ts, unnest({terms_sql(_term_text)}) AS term FROM cl),
top AS ({windows_sql(AS_OF_TEXT)}),
found AS (SELECT window_days, keyword, title, row_number() OVER (
    PARTITION BY window_days, keyword ORDER BY fetched_at DESC, arrival) AS rn
  FROM top JOIN cl ON contains(lower(title), lower(keyword))
    AND fetched_at >= TIMESTAMP '{AS_OF_TEXT}' - to_days(window_days) AND fetched_at <= TIMESTAMP '{AS_OF_TEXT}')
SELECT window_days, keyword, string_agg(title, ' | ' ORDER BY rn) AS samples FROM found
WHERE rn <= {CORPUS.samples_shown} GROUP BY window_days, keyword ORDER BY window_days, keyword LIMIT {CORPUS.trends_shown}""")
def shown_trends(spark, sf):
    """Of an edition's trends those that a page shows, with their first samples."""
    rows = classified(articles(spark, sf), CORPUS).withColumn("ts", F.col("fetched_at"))
    top = TR.top_terms(TR.window_counts(TR.article_terms(rows, ["ts"]), CORPUS.trend_windows, as_of()), CORPUS)
    told = TR.sample_titles(rows, top, as_of(), CORPUS.trend_windows).where(F.size("samples") > 0)  # the top terms of each window
    edition = told.agg(F.array_sort(F.collect_list(F.struct("window_days", "keyword", "samples"))).alias("trends"))
    return ED.shown_trends(edition, CORPUS).select(F.inline("trends")).select(
        "window_days", "keyword", F.array_join("samples", " | ").alias("samples"))


@query("trend_series", f"""WITH {OCCURRENCES_SQL}, daily AS (
  SELECT CAST(ts AS DATE) AS date, term AS keyword, count(*) AS n FROM occ GROUP BY 1, 2),
trail AS (SELECT date, keyword, CAST(sum(n) OVER (PARTITION BY keyword ORDER BY date
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS occurrences FROM daily),
v AS (SELECT *, coalesce(lag(occurrences) OVER (PARTITION BY keyword ORDER BY date), 0) AS prev FROM trail)
SELECT CAST(date AS VARCHAR) AS date, keyword, occurrences, prev,
  round(CASE WHEN prev > 0 THEN (occurrences - prev) / prev::DOUBLE ELSE occurrences::DOUBLE END, 3) AS velocity FROM v""")
def trend_series(spark, sf):
    trail = TR.trailing_counts(TR.daily_counts(occurrences(spark, sf)), 7)
    return TR.velocity_series(trail).select(
        F.col("date").cast("string").alias("date"), "keyword", "occurrences", "prev", "velocity")


BURST = replace(CORPUS, burst_days=2, burst_baseline_days=30, burst_min_ratio=1.5, burst_top=20, trend_min_count=3)


@query("burst_topics", f"""WITH {OCCURRENCES_SQL},
base AS (SELECT *, ts >= TIMESTAMP '{AS_OF_TEXT}' - INTERVAL 2 DAY AS recent FROM occ
  WHERE ts BETWEEN TIMESTAMP '{AS_OF_TEXT}' - INTERVAL 30 DAY AND TIMESTAMP '{AS_OF_TEXT}'),
tot AS (SELECT greatest(1, count(*) FILTER (WHERE recent)) AS r, greatest(1, count(*)) AS b FROM
  (SELECT max(ts) >= TIMESTAMP '{AS_OF_TEXT}' - INTERVAL 2 DAY AS recent FROM base GROUP BY user_id, CAST(ts AS DATE))),
c AS (SELECT term AS keyword, count(*) FILTER (WHERE recent) AS n, count(*) AS nb FROM base GROUP BY term
  HAVING count(*) FILTER (WHERE recent) > 0 ORDER BY n DESC, keyword LIMIT {BURST.burst_terms}),
g AS (SELECT keyword, n AS occurrences_recent, (n / r::DOUBLE) / (nb / b::DOUBLE) AS ratio FROM c, tot)
SELECT keyword, occurrences_recent, round(ratio, 2) AS growth_ratio, false AS is_cjk FROM g
WHERE occurrences_recent >= 3 AND ratio >= {BURST.burst_min_ratio}e0
ORDER BY growth_ratio DESC, occurrences_recent DESC, keyword LIMIT {BURST.burst_top}""")
def burst_topics(spark, sf):
    """Terms are events; a document is what one user did on one day, of the time of the last event."""
    rows = occurrences(spark, sf)
    days = rows.filter(F.col("ts").between(TM.days_before(as_of(), BURST.burst_baseline_days), as_of()))
    return TR.bursts(rows, days.groupBy("user_id", F.to_date("ts")).agg(F.max("ts").alias("ts")), as_of(), BURST)


# ---------------------------------------------------------------- vectors and titles

@query("cosine_to_center", """WITH dims AS (SELECT label, i, avg(x) AS m FROM (
  SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i),
centers AS (SELECT label, list(m ORDER BY i) AS center FROM dims GROUP BY label)
SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], center), 6) AS cosine
FROM embeddings JOIN centers USING (label)""")
def cosine_to_center(spark, sf):
    rows = vectors(spark, sf)
    dims = rows.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centers = dims.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("center"))  # one entry per dimension
    return rows.join(centers, "label").select(
        F.col("arrival").alias("vec_id"), "label",
        F.round(V.cosine(F.col("embedding"), F.col("center")), 6).alias("cosine"))


@query("vector_recent_anti", f"""WITH stored AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE label < 5
    AND TIMESTAMP '{AS_OF_TEXT}' - to_days(CAST(vec_id % 30 AS INTEGER)) - to_hours(CAST(vec_id % 24 AS INTEGER))
      >= TIMESTAMP '{AS_OF_TEXT}' - INTERVAL 14 DAY)
SELECT vec_id FROM embeddings e WHERE label >= 5 AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE list_cosine_similarity(s.v, e.embedding::DOUBLE[]) >= {CORPUS.vector_threshold}e0)""")
def vector_recent_anti(spark, sf):
    rows = vectors(spark, sf).withColumn("url_hash", F.col("arrival").cast("string"))
    old = rows.filter(F.col("label") < 5)
    recent = ST.recent_vectors(old.select("url_hash", "embedding"), old.select("url_hash", "fetched_at"),
                               CORPUS.vector_days, as_of())
    return not_near(rows.filter(F.col("label") >= 5), recent, CORPUS.vector_threshold).select(
        F.col("arrival").alias("vec_id"))


def greedy_sql(rows: str, similar: str) -> str:
    """Sequential keep-first over rows (id, ...) in SQL: one recursion step per row."""
    return f"""e AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM ({rows})),
nb AS MATERIALIZED (SELECT b.rn, list(a.rn) AS ns FROM e a JOIN e b ON a.rn < b.rn AND {similar} GROUP BY b.rn),
steps(rn, kept) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT s.rn + 1, CASE WHEN nb.ns IS NOT NULL AND list_has_any(s.kept, nb.ns) THEN s.kept ELSE list_append(s.kept, s.rn + 1) END
  FROM steps s LEFT JOIN nb ON nb.rn = s.rn + 1 WHERE s.rn < (SELECT max(rn) FROM e)),
kept AS MATERIALIZED (SELECT unnest(kept) AS rn FROM (SELECT kept FROM steps ORDER BY rn DESC LIMIT 1))"""


def _vectors_greedy(threshold: float) -> str:
    return greedy_sql("SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings",
                      f"list_cosine_similarity(a.v, b.v) >= {threshold}e0")


@query("vector_dedup_keep_first", f"""WITH RECURSIVE {_vectors_greedy(CORPUS.vector_threshold)}
SELECT id AS vec_id FROM e JOIN kept USING (rn)""")
def vector_dedup_keep_first(spark, sf):
    return keep_first_vectors(vectors(spark, sf), CORPUS.vector_threshold).select(F.col("arrival").alias("vec_id"))


@query("vector_dedup_blocks", ORACLES["vector_dedup_keep_first"])
def vector_dedup_blocks(spark, sf):
    """The same with limits so low that cells, block pairs, batches and rounds are all used."""
    return keep_first_vectors(vectors(spark, sf), CORPUS.vector_threshold, cell_rows=100, block=64, first_batch=150).select(
        F.col("arrival").alias("vec_id"))


_odd = """CASE vec_id % 5 WHEN 0 THEN list_transform(embedding, lambda x: 0::DOUBLE)
  WHEN 1 THEN list_transform(embedding, lambda x: 'nan'::DOUBLE) WHEN 2 THEN list_transform(embedding, lambda x: 1e-200::DOUBLE)
  WHEN 3 THEN list_append(embedding::DOUBLE[], NULL) ELSE embedding::DOUBLE[] END"""


@query("vector_dedup_odd", f"""WITH RECURSIVE {greedy_sql(
    "SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 5 = 4",
    f"list_cosine_similarity(a.v, b.v) >= {CORPUS.vector_threshold}e0")}
SELECT id AS vec_id FROM e JOIN kept USING (rn) UNION ALL SELECT vec_id FROM embeddings WHERE vec_id % 5 <> 4""")
def vector_dedup_odd(spark, sf):
    """Vectors of zeros, of NaN, of a norm that underflows or with a null are similar to nothing and stay."""
    kind = F.col("arrival") % 5
    odd = (F.when(kind == 0, F.transform("embedding", lambda x: F.lit(0.0)))
           .when(kind == 1, F.transform("embedding", lambda x: F.lit(float("nan"))))
           .when(kind == 2, F.transform("embedding", lambda x: F.lit(1e-200)))
           .when(kind == 3, F.concat("embedding", F.array(F.lit(None).cast("double")))).otherwise(F.col("embedding")))
    rows = vectors(spark, sf).withColumn("embedding", odd).repartition(5, F.pmod("arrival", F.lit(5)))
    return keep_first_vectors(rows, CORPUS.vector_threshold).select(F.col("arrival").alias("vec_id"))


CLUSTERS_SQL = f"""WITH RECURSIVE {_vectors_greedy(CORPUS.cluster_threshold)},
led AS (SELECT m.id, m.rn, min(l.rn) AS lead FROM e m JOIN (SELECT e.* FROM e JOIN kept USING (rn)) l
  ON l.rn = m.rn OR (l.rn < m.rn AND list_cosine_similarity(l.v, m.v) >= {CORPUS.cluster_threshold}e0) GROUP BY m.id, m.rn),
members AS (SELECT led.id, (SELECT id FROM e WHERE e.rn = led.lead) AS leader,
  TIMESTAMP '{AS_OF_TEXT}' - to_days(CAST(led.id % 30 AS INTEGER)) - to_hours(CAST(led.id % 24 AS INTEGER)) AS ts FROM led),
spans AS (SELECT leader, count(*) AS n, min(ts) AS started, max(ts) AS ended FROM members GROUP BY leader
  HAVING count(*) >= {CORPUS.cluster_min} ORDER BY n DESC, leader LIMIT {CORPUS.cluster_top})"""


@query("vector_clusters", f"""{CLUSTERS_SQL}
SELECT leader, n, epoch_us(started) // 1000000 AS started_sec, epoch_us(ended) // 1000000 AS ended_sec FROM spans""")
def vector_clusters(spark, sf):
    members = CL.clustered(vectors(spark, sf), CORPUS.cluster_threshold)
    return CL.cluster_spans(members, "fetched_at", CORPUS).select(
        "leader", "n", F.unix_seconds("started_at").alias("started_sec"), F.unix_seconds("ended_at").alias("ended_sec"))


@query("cluster_timeline", f"""{CLUSTERS_SQL}
SELECT leader, row_number() OVER (PARTITION BY leader ORDER BY ts, id) AS line_no,
  '- ' || strftime(ts, '%Y-%m-%d') || ' · vector ' || id AS line FROM members WHERE leader IN (SELECT leader FROM spans)""")
def cluster_timeline(spark, sf):
    members = CL.clustered(vectors(spark, sf), CORPUS.cluster_threshold)
    spans = CL.cluster_spans(members, "fetched_at", CORPUS)
    return CL.timeline(members, spans, "fetched_at").select("leader", "line_no", "line")


_fetched_sql = f"TIMESTAMP '{AS_OF_TEXT}' - to_days(CAST(id % 30 AS INTEGER)) - to_hours(CAST(id % 24 AS INTEGER))"
_mean_sql = "list_transform(list_zip(c.mean, v), lambda z: (z[1] * c.n + z[2]) / (c.n + 1))"
MOVING_SQL = f"""WITH RECURSIVE e AS MATERIALIZED (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY vec_id DESC) AS rn FROM embeddings),
steps(rn, id, leader, clusters) AS (
  SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::STRUCT(leader BIGINT, n BIGINT, mean DOUBLE[])[]
  UNION ALL
  SELECT rn, id, CASE WHEN hit > 0 THEN clusters[hit].leader ELSE id END, CASE WHEN hit > 0
    THEN list_concat(clusters[:hit - 1], list_transform(clusters[hit:hit], lambda c: {{'leader': c.leader, 'n': c.n + 1, 'mean': {_mean_sql}}}), clusters[hit + 1:])
    ELSE list_append(clusters, {{'leader': id, 'n': 1::BIGINT, 'mean': v}}) END
  FROM (SELECT e.rn, e.id, e.v, s.clusters, coalesce(list_position(
    list_transform(s.clusters, lambda c: list_cosine_similarity(c.mean, e.v) >= {CORPUS.cluster_threshold}e0), true), 0) AS hit
    FROM steps s JOIN e ON e.rn = s.rn + 1)),
members AS MATERIALIZED (SELECT id, leader FROM steps WHERE rn > 0)"""


@query("moving_clusters", f"{MOVING_SQL} SELECT id AS vec_id, leader FROM members")
def moving_clusters(spark, sf):
    """Every row with its cluster; the newest row comes first, means move while rows come in."""
    return MV.moving_clusters(_newest_first(spark, sf), CORPUS.cluster_threshold).select("vec_id", (-F.col("leader")).alias("leader"))


@query("moving_clusters_blocks", ORACLES["moving_clusters"])
def moving_clusters_blocks(spark, sf):
    """The same with limits so low that there are many blocks, tasks, cuts and rewritten means."""
    rows = _newest_first(spark, sf)
    block = max(60, rows.count() // 12)
    return MV.moving_clusters(rows, CORPUS.cluster_threshold, block=block, matches=3, task_means=40, moved=block).select(
        "vec_id", (-F.col("leader")).alias("leader"))


def _newest_first(spark, sf):
    return vectors(spark, sf).select(F.col("arrival").alias("vec_id"), (-F.col("arrival")).alias("arrival"), "embedding", "fetched_at", "title")


@query("narrative_spans", f"""{MOVING_SQL},
spans AS (SELECT leader, count(*) AS n, min({_fetched_sql}) AS started, max({_fetched_sql}) AS ended
  FROM members GROUP BY leader HAVING count(*) >= {CORPUS.cluster_min} ORDER BY n DESC, leader DESC LIMIT {CORPUS.cluster_top}),
entries AS (SELECT m.leader, unnest(range(1, 65)) AS dim, unnest(e.v) AS x FROM members m JOIN e USING (id) JOIN spans USING (leader)),
means AS (SELECT leader, dim, avg(x) AS x FROM entries GROUP BY ALL)
SELECT -spans.leader AS leader, n, epoch_us(started) // 1000000 AS started_sec, epoch_us(ended) // 1000000 AS ended_sec,
  round(sqrt(sum(x * x)), 6) AS mean_length FROM spans JOIN means USING (leader) GROUP BY ALL""")
def narrative_spans(spark, sf):
    """The largest clusters with moving means: size, span, and the length of the mean (short where members differ)."""
    members = MV.moving_clusters(_newest_first(spark, sf), CORPUS.cluster_threshold)
    spans = CL.cluster_spans(members, "fetched_at", CORPUS)
    means = CL.cluster_means(members.join(F.broadcast(spans.select("leader")), "leader", "left_semi"))  # a few leaders
    return spans.join(means.select("leader", F.round(V.norm(F.col("mean")), 6).alias("mean_length")), "leader").select(
        "leader", "n", F.unix_seconds("started_at").alias("started_sec"), F.unix_seconds("ended_at").alias("ended_sec"), "mean_length")


_words_sql = "list_distinct(list_filter(string_split(title, ' '), lambda w: w <> ''))"


def titles_sql(rows: str, threshold: float) -> str:
    """Keep-first of ``rows`` (arrival, title) by token-set ratio. Pairs that lengths and letters leave open get the longest common
    subsequence of their unshared words, row by row in a band, as long as the threshold is within reach."""
    lim = f"CAST(floor({100 - threshold}e0 * (wa + wb) / 100 + 1e-9) AS INT)"
    letters = "lambda z: abs(la - length(replace(oa, z, '')) - lb + length(replace(ob, z, '')))"
    return f"""src AS (SELECT arrival, list_sort({_words_sql}) AS w FROM ({rows})),
t AS MATERIALIZED (SELECT min(arrival) AS id, w FROM src WHERE len(w) > 0 GROUP BY w),
split AS (SELECT a.id AS x, b.id AS y, a.w AS a, b.w AS b, list_intersect(a.w, b.w) AS c FROM t a JOIN t b ON a.id < b.id),
p AS (SELECT x, y, len(c) > 0 AS shared, array_to_string(list_filter(a, lambda z: NOT list_contains(c, z)), ' ') AS oa,
  array_to_string(list_filter(b, lambda z: NOT list_contains(c, z)), ' ') AS ob, length(array_to_string(c, ' ')) AS lc FROM split),
q AS MATERIALIZED (SELECT *, length(oa) AS la, length(ob) AS lb, lc + length(oa) + CAST(shared AS INT) AS wa,
  lc + length(ob) + CAST(shared AS INT) AS wb FROM p),
sure AS (SELECT x, y FROM q WHERE shared AND (oa = '' OR ob = '' OR 100 - 100 * (la + 1) / (lc + wa)::DOUBLE >= {threshold}
  OR 100 - 100 * (lb + 1) / (lc + wb)::DOUBLE >= {threshold})),
hard AS MATERIALIZED (
  SELECT row_number() OVER () AS k, *, CAST(floor((lim + lb - la) / 2) AS INT) AS past, CAST(floor((lim + la - lb) / 2) AS INT) AS back
  FROM (SELECT *, {lim} AS lim FROM q ANTI JOIN sure USING (x, y)) WHERE abs(la - lb) <= lim
    AND list_sum(list_transform(string_split('abcdefghijklmnopqrstuvwxyz', ''), {letters})) <= lim),
lcs(k, i, o, v) AS (
  SELECT k, 0, unnest(range(-back, past + 1)), 0 FROM hard
  UNION ALL
  SELECT k, i, o, v FROM (
    SELECT k, i, o, v, max(v + least(la - i, lb - i - o)) OVER (PARTITION BY k) AS best, la, lb, lim FROM (
      SELECT k, i, o, max(m) OVER (PARTITION BY k ORDER BY o) AS v, la, lb, lim FROM (
        SELECT k, i + 1 AS i, o, la, lb, lim, CASE WHEN i + 1 + o >= 1 AND substring(oa, i + 1, 1) = substring(ob, i + 1 + o, 1)
          THEN v + 1 ELSE lead(v, 1, 0) OVER (PARTITION BY k ORDER BY o) END AS m
        FROM lcs JOIN hard USING (k) WHERE i < la))) WHERE 2 * best >= la + lb - lim),
near AS (SELECT x, y FROM hard JOIN lcs USING (k) WHERE i = la AND o = lb - la AND 100 - 100 * (la + lb - 2 * v) / (wa + wb)::DOUBLE >= {threshold}),
pairs AS MATERIALIZED (SELECT x, y FROM sure UNION ALL SELECT x, y FROM near),
{_of_pairs("SELECT id FROM t")},
left_over AS (SELECT id AS arrival FROM e JOIN kept USING (rn) UNION ALL SELECT arrival FROM src WHERE len(w) = 0)"""


def _of_pairs(rows: str) -> str:
    """Keep-first in SQL with ``pairs`` (x, y) as what is similar."""
    return greedy_sql(rows, "(a.id, b.id) IN (SELECT (x, y) FROM pairs)").replace(
        "FROM e a JOIN e b ON a.rn < b.rn AND (a.id, b.id) IN (SELECT (x, y) FROM pairs)",
        "FROM pairs JOIN e a ON a.id = x JOIN e b ON b.id = y")


@query("title_dedup_keep_first", f"""WITH RECURSIVE {ARTICLES_SQL},
{titles_sql("SELECT arrival, title FROM art", CORPUS.title_threshold)} SELECT arrival FROM left_over""")
def title_dedup_keep_first(spark, sf):
    rows = materialize(headlines(spark, sf), "titles")  # read twice
    return keep_first_titles(rows, CORPUS.title_threshold).select("arrival")


_TYPOS_SQL = """SELECT arrival, left(title, 50) AS title FROM art
UNION ALL SELECT arrival + 1000000000000, replace(replace(left(title, 50), 'th', 'ht'), 'nd', 'n') FROM art"""


@query("title_dedup_typos", f"""WITH RECURSIVE {ARTICLES_SQL},
{titles_sql(_TYPOS_SQL, 85.0)} SELECT arrival FROM left_over""")
def title_dedup_typos(spark, sf):
    """Beginnings of titles beside copies with typing errors, so that distances decide; blocks and batches are small."""
    rows = materialize(headlines(spark, sf).select("arrival", F.left("title", F.lit(50)).alias("title")), "titles")  # read more than once
    typed = rows.select((F.col("arrival") + 1000000000000).alias("arrival"), F.replace(F.replace("title", F.lit("th"), F.lit("ht")), F.lit("nd"), F.lit("n")).alias("title"))
    return keep_first_titles(rows.unionByName(typed), 85.0, block=128, first_batch=700).select("arrival")


_subset_sql = f"""w AS MATERIALIZED (SELECT id, len(t) AS size, unnest(t) AS word FROM (SELECT arrival AS id, {_words_sql} AS t FROM art)),
sub AS (SELECT a.id AS x, b.id AS y FROM w a JOIN w b ON a.word = b.word AND a.id <> b.id
  GROUP BY a.id, b.id, a.size HAVING count(*) = a.size),
pairs AS MATERIALIZED (SELECT DISTINCT least(x, y) AS x, greatest(x, y) AS y FROM sub)"""


@query("title_contained_keep_first", f"""WITH RECURSIVE {ARTICLES_SQL}, {_subset_sql},
{_of_pairs("SELECT arrival AS id FROM art")}
SELECT id AS arrival FROM e JOIN kept USING (rn)""")
def title_contained_keep_first(spark, sf):
    return keep_first_titles(materialize(headlines(spark, sf), "titles"), 100.0).select("arrival")  # read more than once


@query("title_contained_split", ORACLES["title_contained_keep_first"])
def title_contained_split(spark, sf):
    """The same with limits so low that keys are split and rows come in batches."""
    return keep_first_titles(materialize(headlines(spark, sf), "titles"), 100.0, limit=40, first_batch=300).select("arrival")


# ---------------------------------------------------------------- keyed state

_STORED_SQL = f"{ARTICLES_SQL}, stored AS (SELECT DISTINCT url_hash FROM art WHERE lang = 'de')"


@query("known_anti", f"""WITH {_STORED_SQL}
SELECT url_hash, min(arrival) AS arrival FROM art WHERE url_hash NOT IN (SELECT url_hash FROM stored) GROUP BY url_hash""")
def known_anti(spark, sf):
    rows = articles(spark, sf)
    return K.new_articles(rows, rows.filter(F.col("lang") == "de")).select("url_hash", "arrival")


@query("dedup_stats", f"""WITH {_STORED_SQL}, k AS (
  SELECT url_hash, count(*) AS n, url_hash IN (SELECT url_hash FROM stored) AS known FROM art GROUP BY url_hash)
SELECT CAST(coalesce(sum(n) FILTER (WHERE known), 0) AS BIGINT) AS by_db,
  CAST(coalesce(sum(n - 1) FILTER (WHERE NOT known), 0) AS BIGINT) AS by_url FROM k""")
def dedup_stats(spark, sf):
    rows = articles(spark, sf)
    return K.keyed_drop_counts(rows, rows.filter(F.col("lang") == "de"))


@query("drop_reasons", f"""WITH {_STORED_SQL}, r AS (
  SELECT CASE WHEN url_hash IN (SELECT url_hash FROM stored) THEN 'by_db'
    WHEN row_number() OVER (PARTITION BY url_hash ORDER BY arrival) > 1 THEN 'by_url' ELSE 'kept' END AS drop_reason FROM art)
SELECT drop_reason, count(*) AS n FROM r GROUP BY drop_reason""")
def drop_reasons(spark, sf):
    rows = articles(spark, sf).select("url_hash", "arrival", "lang")
    facts = rows.groupBy("url_hash").agg(
        F.min("arrival").alias("first"), F.max(F.col("lang") == "de").alias("stored"), F.count(F.lit(1)).alias("n"))
    reasons = facts.select(F.inline(F.array(
        F.struct(F.when(F.col("stored"), "by_db").otherwise("by_url").alias("drop_reason"),
                 F.when(F.col("stored"), F.col("n")).otherwise(F.col("n") - 1).alias("n")),
        F.struct(F.lit("kept").alias("drop_reason"), F.when(F.col("stored"), 0).otherwise(1).cast("long").alias("n")))))
    return reasons.groupBy("drop_reason").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


_early = "ts < TIMESTAMP '2024-01-20 00:00:00'"
_late = "ts >= TIMESTAMP '2024-01-10 00:00:00'"


@query("upsert_latest", f"""SELECT user_id, event_type, event_id, value FROM (
  SELECT *, 0 AS side FROM events WHERE {_early} UNION ALL SELECT *, 1 AS side FROM events WHERE {_late})
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC, side DESC) = 1""")
def upsert_latest(spark, sf):
    """Two writes to a state table; the second one overlaps the first."""
    rows = occurrences(spark, sf).select("user_id", "event_type", "event_id", "value", "ts")
    path = scratch_path(spark, "upsert")
    for part in (rows.filter(F.col("ts") < TM.instant("2024-01-20")), rows.filter(F.col("ts") >= TM.instant("2024-01-10"))):
        T.upsert(part, path, ["user_id", "event_type"], "event_id", buckets=8)
    return spark.read.parquet(path).select("user_id", "event_type", "event_id", "value")


@query("upsert_rerun", f"""SELECT user_id, event_type, n FROM (
  SELECT user_id, event_type, count(*) AS n, 1 AS side FROM events WHERE {_late} GROUP BY ALL
  UNION ALL SELECT user_id, event_type, count(*), 0 FROM events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY side DESC) = 1""")
def upsert_rerun(spark, sf):
    """A rerun with lower counts replaces what was stored: the later write wins, not the larger value."""
    rows = occurrences(spark, sf)
    path = scratch_path(spark, "rerun")
    for part in (rows, rows.filter(F.col("ts") >= TM.instant("2024-01-10"))):
        T.upsert(part.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")), path, ["user_id", "event_type"], buckets=8)
    return spark.read.parquet(path).select("user_id", "event_type", "n")


@query("insert_ignore", """SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type""")
def insert_ignore(spark, sf):
    rows = occurrences(spark, sf).select("user_id", "event_type", "event_id", "ts")
    path = scratch_path(spark, "insert")
    for part in (rows.filter(F.col("ts") < TM.instant("2024-01-20")), rows.filter(F.col("ts") >= TM.instant("2024-01-10"))):
        T.insert_ignore(part, path, ["user_id", "event_type"], [F.col("event_id")])
    return spark.read.parquet(path).select("user_id", "event_type", "event_id")


@query("run_latest", """SELECT user_id AS run_id, event_type AS status, event_id, value FROM events
WHERE event_type = 'signup' ORDER BY ts DESC, user_id DESC LIMIT 1""")
def run_latest(spark, sf):
    runs = occurrences(spark, sf).select(
        F.col("user_id").alias("run_id"), F.when(F.col("event_type") == "signup", "success")
        .otherwise(F.col("event_type")).alias("status"), "ts", "event_id", "value")
    return RU.last_success(runs).select("run_id", F.lit("signup").alias("status"), "event_id", "value")


@query("run_status", """SELECT user_id AS run_id, event_type AS status, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1""")
def run_status(spark, sf):
    """Status rows of one day have one time, so their number decides."""
    runs = occurrences(spark, sf).withColumnsRenamed({"user_id": "run_id", "event_type": "status"}).withColumns(
        {"ts": F.to_date("ts").cast("timestamp"), "seq": F.col("event_id")})
    return RU.current_status(runs).select("run_id", "status", "event_id")


_number = "CAST(substr(source, 4) AS INTEGER)"
_limit_case = f"CASE {_number} % 4 + 1 {_limits} END"


SOURCE_SCAN_SQL = f"""WITH d AS (SELECT *, {_number} AS k FROM documents WHERE {_number} NOT IN (9, 18)),
feed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS p FROM d WHERE k < 10),
head AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS p FROM d WHERE k >= 10),
told AS (SELECT * EXCLUDE (p), row_number() OVER (PARTITION BY source ORDER BY doc_id) AS p FROM head
  WHERE p <= {L.STORY_HEAD} AND doc_id % 5 <> 0 AND doc_id % 2 = 0)
SELECT source AS source_id, 'https://' || source || '.example.org/' || doc_id AS url, 'Title & ' || doc_id AS title, k % 4 + 1 AS tier,
  epoch_us(DATE '2024-01-30' - CAST(doc_id % 30 AS INTEGER)) // 1000000 + 37230 AS published_sec
FROM feed WHERE p <= {_limit_case} AND doc_id % 7 <> 0
UNION ALL SELECT source, CASE WHEN doc_id % 3 = 0 THEN '{L.STORY_LINK}' || doc_id ELSE 'https://' || source || '.example.org/' || doc_id END,
  'A model ' || doc_id, k % 4 + 1, 1700000000 + doc_id FROM told WHERE p <= {_limit_case}"""


@query("source_scan", SOURCE_SCAN_SQL)
def source_scan(spark, sf):
    """Documents landed as feeds and stories, one folder per source, and scanned again through the registry."""
    landing, registry = _landed_feeds(spark, sf)
    return L.scanned(spark, landing, registry, CORPUS, as_of()).select(
        "source_id", "url", "title", "tier", F.unix_seconds("published_at").alias("published_sec"))


def _landed_feeds(spark, sf, cut_off=(), broken=(), missing=()):
    """(landing folder, registry): documents as feeds of the sources below 10 and as stories of the others. Feeds that were cut
    off lack their end, broken ones have a bad record, missing ones did not land."""
    landing = scratch_path(spark, "landing")
    number = F.substr("source", F.lit(4)).cast("int")
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("source_id"), number.alias("k"))
    doc, link = F.col("doc_id"), F.concat(F.lit("https://"), F.col("source_id"), F.lit(".example.org/"), F.col("doc_id"))
    day = F.date_format(F.date_sub(F.lit("2024-01-30").cast("date"), (doc % 30).cast("int")), "EEE, d MMM yyyy")
    item = F.concat(F.lit("<item><title>Title &amp; "), doc, F.lit("</title>"),
                    F.when(doc % 7 != 0, F.concat(F.lit("<link>"), link, F.lit("</link>"))).otherwise(""),
                    F.lit("<description>x</description><pubDate>"), day, F.lit(" 10:20:30 GMT</pubDate></item>"))
    story = F.to_json(F.struct(
        doc.alias("id"), F.when(doc % 5 == 0, "job").otherwise("story").alias("type"),
        F.concat(F.when(doc % 2 == 0, "A model ").otherwise("misc "), doc).alias("title"),
        F.when(doc % 3 != 0, link).alias("url"), (doc + 1700000000).alias("time"), doc.alias("rank")))
    feeds = docs.filter("k < 10").select("source_id", "doc_id", item.alias("value"))
    frame = feeds.select("source_id").distinct().select("source_id", F.inline(F.array(
        F.struct(F.lit(-1).cast("long").alias("doc_id"), F.lit("<rss><channel>").alias("value")),
        F.struct(F.lit(2**62).alias("doc_id"), F.lit("</channel></rss>").alias("value")))))
    told = docs.filter("k >= 10").select("source_id", "doc_id", story.alias("value"))
    bad = told.select("source_id").distinct().filter(F.col("source_id").isin(*broken)).select(
        "source_id", F.lit(-1).cast("long").alias("doc_id"), F.lit('{"id": 1, "type": "sto').alias("value"))
    frame = frame.filter(~((F.col("doc_id") > 0) & F.col("source_id").isin(*cut_off)))
    for kind, rows in (("rss", feeds.unionByName(frame)), ("hn_api", told.unionByName(bad))):
        laid = rows.filter(~F.col("source_id").isin(*missing)).repartition("source_id").sortWithinPartitions("source_id", "doc_id").select("source_id", "value")
        laid.write.partitionBy("source_id").text(f"{landing}/{kind}")
    registry = docs.select("source_id", "k").distinct().select(
        F.col("source_id").alias("id"), F.col("source_id").alias("name"), (F.col("k") % 4 + 1).cast("int").alias("tier"),
        F.when(F.col("k") == 18, "ftp").when(F.col("k") < 10, "rss").otherwise("hn_api").alias("type"), F.lit("").alias("url"),
        F.lit(0.8).alias("confidence"), (F.col("k") != 9).alias("enabled"))
    return landing, registry


_failed = ("src3", "src7", "src12")


@query("cached_fallback", f"""WITH {ARTICLES_SQL}
SELECT source_id, arrival, false AS from_cache FROM art WHERE source_id NOT IN {_failed}
UNION ALL SELECT source_id, arrival, true FROM art WHERE source_id IN {_failed} AND date <= DATE '2024-01-15'""")
def cached_fallback(spark, sf):
    rows = articles(spark, sf).select("source_id", "arrival", "date")
    failed = spark.createDataFrame([(s,) for s in _failed], "source_id string")
    live = rows.filter(~F.col("source_id").isin(*_failed)).withColumn("from_cache", F.lit(False))
    cache = rows.filter(F.col("date") <= F.lit("2024-01-15").cast("date")).withColumn("from_cache", F.lit(True))
    return L.with_cached(live, cache, failed).select("source_id", "arrival", "from_cache")


@query("scan_or_cache", f"""SELECT source_id, url, false AS from_cache FROM ({SOURCE_SCAN_SQL}) WHERE source_id NOT IN {_failed}
UNION ALL SELECT source, 'https://cache.example.org/' || doc_id, true FROM documents WHERE source IN {_failed} AND doc_id % 4 = 0""")
def scan_or_cache(spark, sf):
    """A feed that was cut off, a source without a file and a broken story record: the scan finds them, the cache steps in."""
    landing, registry = _landed_feeds(spark, sf, cut_off=_failed[:1], missing=_failed[1:2], broken=_failed[2:])
    docs = table(spark, sf, "documents").filter(F.col("doc_id") % 4 == 0)
    cache = docs.select(F.col("source").alias("source_id"), F.concat(F.lit("https://cache.example.org/"), "doc_id").alias("url"))
    rows, _ = L.scanned_or_cached(spark, landing, registry, cache, CORPUS, as_of())
    return rows.select("source_id", "url", "from_cache")


@query("scan_rejects", f"""SELECT source AS source_id, CASE source WHEN '{_failed[0]}' THEN 'broken feed file' WHEN '{_failed[1]}' THEN 'nothing landed'
  ELSE 'broken record' END AS reason, 1::BIGINT AS n FROM documents WHERE source IN {_failed} GROUP BY source""")
def scan_rejects(spark, sf):
    """Why sources failed, and how many of their files or records."""
    landing, registry = _landed_feeds(spark, sf, cut_off=_failed[:1], missing=_failed[1:2], broken=_failed[2:])
    return L.scan_failures(spark, landing, registry)


# ---------------------------------------------------------------- budget

@query("token_cost_rollup", f"""WITH {LEDGER_SQL}
SELECT month, day, kind, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS calls,
  CASE WHEN grouping(day) = 0 THEN 'day' WHEN grouping(kind) = 0 THEN 'kind' ELSE 'month' END AS level
FROM led GROUP BY GROUPING SETS ((month), (month, day), (month, kind))""")
def token_cost_rollup(spark, sf):
    return B.usage(ledger(spark, sf)).select("month", "day", "kind", "tokens", "calls", "level")


@query("budget_running", f"""WITH {LEDGER_SQL}, r AS (
  SELECT *, CAST(sum(tokens) OVER (PARTITION BY day ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM led)
SELECT conv_id, turn, day, tokens, used, used > {CORPUS.daily_token_budget} AS over_cap FROM r""")
def budget_running(spark, sf):
    return B.running_usage(ledger(spark, sf), ["day"], ["conv_id", "turn"], CORPUS.daily_token_budget).select(
        "conv_id", "turn", "day", "tokens", "used", "over_cap")


@query("budget_running_chunks", ORACLES["budget_running"])
def budget_running_chunks(spark, sf):
    """The same with every day cut into chunks."""
    return B.running_usage(ledger(spark, sf), ["day"], ["conv_id", "turn"], CORPUS.daily_token_budget, group_limit=5, chunks=7).select(
        "conv_id", "turn", "day", "tokens", "used", "over_cap")


@query("budget_running_null_day", f"""WITH {LEDGER_SQL}, n AS (SELECT * REPLACE (CASE WHEN day % 3 <> 0 THEN day END AS day) FROM led)
SELECT conv_id, turn, day, tokens, CAST(sum(tokens) OVER (PARTITION BY day ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM n""")
def budget_running_null_day(spark, sf):
    """Calls without a day are a group of their own, whatever form is used."""
    rows = ledger(spark, sf).withColumn("day", F.when(F.col("day") % 3 != 0, F.col("day")))
    return B.running_usage(rows, ["day"], ["conv_id", "turn"], 1, group_limit=5, chunks=7).select("conv_id", "turn", "day", "tokens", "used")


@query("budget_admission", f"""WITH RECURSIVE {LEDGER_SQL},
o AS (SELECT *, row_number() OVER (ORDER BY day, conv_id, turn) AS rn FROM led),
f(rn, day, used_day, used_month, ok) AS (
  SELECT 0::BIGINT, -1::BIGINT, 0::BIGINT, 0::BIGINT, false
  UNION ALL
  SELECT rn, day, base + CASE WHEN fits THEN tokens ELSE 0 END, used_month + CASE WHEN fits THEN tokens ELSE 0 END, fits
  FROM (SELECT *, base + tokens <= {CORPUS.daily_token_budget} AND used_month + tokens <= {CORPUS.monthly_token_budget} AS fits
    FROM (SELECT o.rn, o.day, o.tokens, f.used_month, CASE WHEN o.day = f.day THEN f.used_day ELSE 0 END AS base
      FROM f JOIN o ON o.rn = f.rn + 1)))
SELECT o.conv_id, o.turn, o.day, o.tokens, f.ok AS admitted FROM f JOIN o USING (rn)""")
def budget_admission(spark, sf):
    return B.admitted(ledger(spark, sf), ["conv_id", "turn"], CORPUS.daily_token_budget, CORPUS.monthly_token_budget).select(
        "conv_id", "turn", "day", "tokens", "admitted")


@query("budget_admission_phases", ORACLES["budget_admission"])
def budget_admission_phases(spark, sf):
    """The same with groups worked off in phases."""
    return B.admitted(ledger(spark, sf), ["conv_id", "turn"], CORPUS.daily_token_budget, CORPUS.monthly_token_budget,
                      group_limit=8, chunks=5).select("conv_id", "turn", "day", "tokens", "admitted")


@query("json_extract", """SELECT event_id,
  CASE WHEN event_id % 3 = 0 THEN CAST(-1 AS INTEGER) ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events""")
def json_extract(spark, sf):
    answer = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure: "), F.substr("props", F.lit(1), F.lit(4)))).otherwise(
        F.concat(F.lit("Here it is:\n"), F.col("props"), F.lit("\nthat is all")))
    parsed = X.embedded_json(answer, "k INT", F.struct(F.lit(-1).alias("k")))
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


# ---------------------------------------------------------------- streaming

def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    rows = J.file_stream(spark, f"{sf}/event[s].parquet", schema)
    key = F.from_json("props", "k INT")["k"]
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "term", F.concat_ws("_", "event_type", key.cast("string")))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    kept = J.first_seen(_event_stream(spark, sf), ["user_id", "event_type"], "ts", "60 days")
    out = J.run_to_end(spark, "stream-dedup", lambda path, state: J.append_to(
        kept.select("user_id", "event_type"), path, state))
    return spark.read.parquet(out)


@query("stream_trend", f"""WITH {OCCURRENCES_SQL}, daily AS (
  SELECT CAST(ts AS DATE) AS date, term AS keyword, count(*) AS n FROM occ GROUP BY 1, 2)
SELECT CAST(date AS VARCHAR) AS date, keyword, CAST(sum(n) OVER (PARTITION BY keyword ORDER BY date
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS occurrences FROM daily""")
def stream_trend(spark, sf):
    """Daily counts kept up to date by a stream; the trailing week is read from them."""
    counts = J.daily_term_counts(_event_stream(spark, sf), "ts", "term", "2 days")
    log = J.run_to_end(spark, "stream-trend", lambda path, state: J.upsert_each_batch(counts, path, state))
    daily = J.current_rows(spark, log, ["date", "keyword"])
    return TR.trailing_counts(daily, 7).select(F.col("date").cast("string").alias("date"), "keyword", "occurrences")


_LANDING = "CASE WHEN event_id % 20 = 0 THEN 2 WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END"
LANDED_SQL = f"{OCCURRENCES_SQL}, landed AS (SELECT *, {_LANDING} AS batch FROM occ)"


def _landings(spark, sf, label, run):
    """Occurrences that land in three batches, the last one out of order; ``run`` follows each landing from its checkpoint."""
    base = scratch_path(spark, label)
    rows = occurrences(spark, sf).withColumn("batch", F.expr(_LANDING))
    last = None
    for batch in range(3):
        rows.where(F.col("batch") == batch).write.mode("append").parquet(f"{base}/in")
        stream = J.file_stream(spark, f"{base}/in", rows.schema)
        last = run(stream, f"{base}/out", f"{base}/state")
        last.awaitTermination()
    return f"{base}/out", last


@query("stream_first_ever", f"""WITH {LANDED_SQL}
SELECT event_id, user_id, event_type FROM landed WHERE user_id % 10 <> 0
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch, ts, event_id) = 1""")
def stream_first_ever(spark, sf):
    """Dedup without a horizon, weeks apart and over restarts; keys of every tenth user are stored already."""
    keys = ["user_id", "event_type"]
    stored = occurrences(spark, sf).where(F.col("user_id") % 10 == 0).select(*keys)
    log, _ = _landings(spark, sf, "first-ever", lambda stream, out, state: EV.first_ever(
        stream, out, keys, [F.col("ts"), F.col("event_id")], state, stored, buckets=8))
    return spark.read.parquet(log).select("event_id", *keys)


@query("stream_sliding", f"""WITH {LANDED_SQL},
seen AS (SELECT k AS batch, (SELECT max(ts) FROM landed WHERE batch < k) - INTERVAL 2 DAY AS mark FROM range(3) r(k)),
entries AS (SELECT term AS keyword, batch, date_trunc('day', ts) - to_days(CAST(i AS INTEGER)) AS start FROM landed, range(7) r(i)),
timely AS (SELECT e.*, coalesce(e.start + INTERVAL 7 DAY > mark, true) AS counts FROM entries e JOIN seen USING (batch))
SELECT CAST(CAST(start AS DATE) AS VARCHAR) AS window_start, keyword, count(*) AS occurrences,
  (SELECT bool_or(NOT counts) FROM timely) AS some_late
FROM timely WHERE counts AND start + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM landed) GROUP BY start, keyword""")
def stream_sliding(spark, sf):
    """Sliding weeks in event time, final once the watermark passed; stragglers behind it are dropped and noted."""
    late = J.LateRows()
    spark.streams.addListener(late)
    try:
        out, last = _landings(spark, sf, "sliding", lambda stream, path, state: J.append_to(
            J.sliding_term_counts(stream, "ts", "term", 7, "2 days"), path, state))
        dropped = late.of(last)
    finally:
        spark.streams.removeListener(late)
    return spark.read.parquet(out).select(
        F.col("window_start").cast("string").alias("window_start"), "keyword", "occurrences", F.lit(dropped > 0).alias("some_late"))


@query("trend_direction", f"""WITH {OCCURRENCES_SQL}, h AS (
  SELECT term AS keyword, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16 00:00:00') AS a,
    count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16 00:00:00') AS b FROM occ GROUP BY term)
SELECT keyword, CASE WHEN v > 0.5e0 THEN 'up' WHEN v < -0.2e0 THEN 'down' ELSE 'flat' END AS direction
FROM (SELECT keyword, CASE WHEN a > 0 THEN (b - a) / a::DOUBLE ELSE b::DOUBLE END AS v FROM h)""")
def trend_direction(spark, sf):
    half = TM.instant("2024-01-16")
    counts = occurrences(spark, sf).groupBy(F.col("term").alias("keyword")).agg(
        F.count_if(F.col("ts") < half).alias("a"), F.count_if(F.col("ts") >= half).alias("b"))
    velocity = F.when(F.col("a") > 0, (F.col("b") - F.col("a")) / F.col("a")).otherwise(F.col("b").cast("double"))
    return counts.select("keyword", R.band(velocity).alias("direction"))
