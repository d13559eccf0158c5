"""The daily run: raw items to a stored edition, and publishing from the archive."""
from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.times import days_before, instant
from ..operators import cluster, edition, keyed, moving, posting, trends
from ..operators.enrich import enriched
from ..operators.expand import source_candidates
from ..operators.normalize import normalize
from ..operators.score import policy_boosted, publishable, scored
from ..operators.sections import placed
from ..operators.title_join import keep_first_titles
from ..operators.vector_join import keep_first_vectors, not_near
from ..params import Settings
from ..session import configure, counted, materialize
from ..sources import landed, state, tables

#: what decides which copy of an item came first, when the rows don't say so themselves
ARRIVAL_ORDER = ["source_id", "feed_pos", "published_at", "url", "title"]
ARTICLE_COLUMNS = [
    "url_hash", "url", "title", "description", "summary", "insight", "perspective", "importance", "market_impact",
    "tags", "section", "source_id", "source_name", "source_confidence", "tier", "relevance", "novelty", "impact",
    "taiwan_related", "market_signal", "policy_flag", "final_score", "published_at", "fetched_at", "arrival",
]
STORED_ARTICLE = ", ".join([
    "url_hash string, url string, title string, description string, summary string, insight string",
    "perspective string, importance string, market_impact string, tags array<string>, section string",
    "source_id string, source_name string, source_confidence double, tier int, relevance double, novelty double",
    "impact double, taiwan_related double, market_signal double, policy_flag boolean, final_score double",
    "published_at timestamp, fetched_at timestamp, arrival bigint, date date",
])


@dataclass(frozen=True)
class Paths:
    """Folders of the state tables below one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def deduplicated(
    articles: DataFrame, stored: DataFrame, vectors: DataFrame | None, recent: DataFrame | None, cfg: Settings,
) -> tuple[DataFrame, dict[str, int]]:
    """Kept articles and rows dropped per layer; cheap layers first, each on what the last one left."""
    counts = keyed.keyed_drop_counts(articles, stored).first().asDict()
    single, n_single = counted(keyed.new_articles(articles, stored), "keyed")
    kept, n_titled = counted(keep_first_titles(single, cfg.title_threshold), "titled")
    n_kept = n_titled
    if vectors is not None:
        rows = kept.join(vectors.withColumnRenamed("vector", "embedding"), "url_hash", "left")
        if recent is not None:
            rows = not_near(rows, recent.withColumnRenamed("vector", "embedding"), cfg.vector_threshold)
        kept, n_kept = counted(keep_first_vectors(materialize(rows, "vectors"), cfg.vector_threshold), "kept")
    counts |= {"by_title": n_single - n_titled, "by_embedding": n_titled - n_kept}
    return kept, counts


def process(
    spark: SparkSession, raw: DataFrame, paths: Paths, as_of: dt.datetime, cfg: Settings | None = None,
    answers: DataFrame | None = None, vectors: DataFrame | None = None, stories: DataFrame | None = None,
) -> DataFrame:
    """Runs one day and returns its edition, which is stored by then.

    ``answers`` (per url_hash), ``vectors`` (url_hash, vector) and ``stories`` (per cluster leader) are
    model output that was made elsewhere; without them rules and defaults fill in.
    """
    configure(spark)
    cfg = cfg or Settings()
    now, day = instant(as_of), as_of.date()
    run_id, started = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", time.monotonic()  # grows with the start
    tables.append_run(spark, paths.runs, run_id, "running", now, {})
    try:
        stages = [("start", time.monotonic())]
        numbered = raw if "arrival" in raw.columns else landed.numbered(raw, [c for c in ARRIVAL_ORDER if c in raw.columns])
        fetched = Observation("fetched")
        seen = numbered.observe(fetched, F.count(F.lit(1)).alias("n"))
        articles, n_normal = counted(normalize(seen, now), "normalized")
        stages.append(("fetch", time.monotonic()))

        stored = state_table(spark, paths.articles, STORED_ARTICLE)
        recent = None
        if vectors is not None:
            recent = state.recent_vectors(
                state_table(spark, paths.embeddings, schemas.EMBEDDING).select("url_hash", "vector"), stored,
                cfg.vector_days, now)
        kept, drops = deduplicated(articles, stored, vectors, recent, cfg)
        stages.append(("dedup", time.monotonic()))

        rows = publishable(policy_boosted(scored(kept, cfg, now), cfg), cfg)
        published, n_published = counted(enriched(rows, answers, cfg).select(*ARTICLE_COLUMNS), "published")
        stages.append(("score", time.monotonic()))
        tables.append_articles(published, paths.articles)
        if vectors is not None:
            kept_vectors = kept.filter(F.size("embedding") > 0).select(
                "url_hash", F.col("embedding").alias("vector"), now.alias("created_at"))
            tables.upsert(kept_vectors, paths.embeddings, ["url_hash"])

        window = state.articles_in_window(
            state_table(spark, paths.articles, STORED_ARTICLE), cfg.burst_baseline_days, now).withColumn(
            "ts", F.col("fetched_at"))
        history = state_table(spark, paths.trends, schemas.TREND)
        moved = materialize(trends.trends(window, history, day, now, cfg).select(
            "date", "window_days", "keyword", "occurrences", "velocity", "samples"), "trends")
        tables.upsert(moved, paths.trends, ["date", "window_days", "keyword"], partition="date")
        emerging = trends.bursts(trends.article_terms(window, ["ts"]), window, now, cfg)
        suggested = materialize(source_candidates(published, state.source_registry(spark, cfg)), "candidates")
        tables.insert_ignore(
            suggested.withColumns({"status": F.lit("pending"), "suggested_at": now}),
            paths.source_candidates, ["url"], [F.col("n").desc()])
        told = None
        if vectors is not None:
            told = narrated(window, state_table(spark, paths.embeddings, schemas.EMBEDDING), stories, cfg, now)
            if stories is not None:
                tables.upsert(told.select("thread_title", "arc", "implication", "started_at", "ended_at"),
                              paths.narratives, ["thread_title", "started_at"])

        result = assembled(published, moved, emerging, suggested, told, drops, day, now, cfg)
        tables.write_edition(materialize(result, "edition"), paths.archive)
        tables.append_run(spark, paths.runs, run_id, "success", now, {
            "articles_fetched": fetched.get["n"], "articles_rejected": fetched.get["n"] - n_normal, "articles_filtered": n_published,
            "dedup_drop_total": sum(drops.values()), **{f"dedup_{k}": v for k, v in drops.items()},
            **{f"{name}_seconds": round(end - start, 3) for (_, start), (name, end) in zip(stages, stages[1:])},
            "elapsed_seconds": round(time.monotonic() - started, 3)})
        return state.edition_of(spark.read.parquet(paths.archive), day)
    except Exception:
        tables.append_run(spark, paths.runs, run_id, "failed", now, {
            "elapsed_seconds": round(time.monotonic() - started, 3)})
        raise


def state_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return tables.read(spark, path, schema)


def narrated(window: DataFrame, vectors: DataFrame, stories: DataFrame | None, cfg: Settings, now) -> DataFrame:
    """Largest story clusters of the last days: newest article first, means move with each member."""
    recent = window.filter(F.col("fetched_at") >= days_before(now, cfg.cluster_days))
    rows = recent.join(vectors.select("url_hash", F.col("vector").alias("embedding")), "url_hash")
    # newest first: sorted over all partitions, numbered within and across them
    ordered = rows.orderBy(F.col("fetched_at").desc(), "url_hash").withColumn(
        "order_no", F.monotonically_increasing_id()).withColumn("at", F.coalesce("published_at", "fetched_at"))
    members = moving.moving_clusters(ordered, cfg.cluster_threshold, arrival="order_no")
    return cluster.narratives(cluster.cluster_spans(members, "at", cfg), stories)


def assembled(published, moved, emerging, suggested, told, drops, day, now, cfg: Settings) -> DataFrame:
    """One nested row: sections, dashboard, trends, narratives, intelligence, evaluation. All parts are bounded."""
    dated = published.withColumn("date", F.lit(day))
    body = edition.nested(placed(dated, cfg, ["date"]), cfg)
    empty = published.sparkSession.range(1).select(
        F.lit(day).alias("date"), F.lit("2.0").alias("schema_version"),
        F.array(*[F.struct(F.lit(i).alias("id"), F.lit(icon).alias("icon"), F.lit(label).alias("label"),
                           F.array().cast(body.schema["sections"].dataType.elementType["articles"].dataType).alias("articles"))
                  for i, icon, label in cfg.sections]).alias("sections"))
    body = materialize(body.unionByName(empty.join(body.select("date"), "date", "left_anti")), "body")

    def listed(rows: DataFrame, name: str, order: list, *columns: str) -> DataFrame:
        held = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], F.struct(*columns).alias("item"))))
        return rows.agg(F.transform(held, lambda x: x["item"]).alias(name)).withColumn("date", F.lit(day))

    dropped = published.sparkSession.range(1).select(
        F.lit(day).alias("date"), F.lit(sum(drops.values())).cast("long").alias("dropped"))
    mark = edition.evaluated(body, cfg, dropped).select("date", F.struct(
        "overall", F.struct("coverage", "diversity", "quality", "insight_rate").alias("components"), "warnings",
    ).alias("evaluation"))
    shown = edition.cards(body, moved.groupBy("date").agg(F.count(F.lit(1)).alias("n_trends"))).groupBy("date").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "label", "value"))),
                    lambda c: F.struct(c["label"].alias("label"), c["value"].alias("value"))).alias("dashboard"))
    out = body.withColumns({"generated_at": now, "dedup": F.create_map(
        *[x for k, v in drops.items() for x in (F.lit(k), F.lit(int(v)))])})
    parts = [
        shown, mark, listed(trends.fastest(moved, cfg), "trends", [-F.col("velocity"), -F.col("occurrences"), F.col("window_days"), F.col("keyword")], "keyword", "window_days", "occurrences", "velocity", "samples"),
        listed(emerging, "emerging_topics", [-F.col("growth_ratio"), -F.col("occurrences_recent"), F.col("keyword")], "keyword", "occurrences_recent", "growth_ratio", "is_cjk"),
        listed(suggested, "suggested_sources", [-F.col("n"), F.col("host")], "host", "url", "n", "score", "reason"),
    ]
    if told is not None:
        parts.append(listed(told, "narratives", [F.col("started_at"), F.col("thread_title")], "thread_title", "arc", "implication", "started_at", "ended_at"))
    for part in parts:
        out = out.join(part, "date", "left")
    return out


def publish(spark: SparkSession, paths: Paths, day: dt.date, cfg: Settings | None = None) -> DataFrame:
    """Writes search table and edition index from the archive; returns the alert rows of the day."""
    configure(spark)
    cfg = cfg or Settings()
    number = F.lit(None).cast("int")
    if landed.exists(spark, paths.archive):
        archive = spark.read.parquet(paths.archive)
        chosen = state.edition_or_latest(archive, day)
        flat = edition.flattened(chosen, cfg)
        tables.write_search_index(flat, paths.search_index)
        posting.write_postings(flat, paths.search_postings)
        tables.write_edition_index(tables.unindexed(archive, chosen, paths.edition_index), paths.edition_index)
        number = chosen.agg(F.max(edition.n_articles())).scalar()  # one edition at most
    checked = spark.range(1).select(F.lit(day).alias("date"), number.alias("n_articles"))
    return edition.alerts(checked.select(
        "date", "n_articles", F.lit(True).alias("email_ok"), F.lit(True).alias("publish_ok"),
        F.array().cast("array<string>").alias("errors")), cfg)
