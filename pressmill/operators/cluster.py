"""Story clusters: leaders by greedy selection, members by their earliest leader; what is told of a cluster.

``moving.py`` has the clusters whose means move."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import Settings
from ..session import materialize
from .layout import running_sum
from .vector_join import assign_first, keep_first_vectors


def clustered(rows: DataFrame, threshold: float, vector: str = "embedding", arrival: str = "arrival", **limits) -> DataFrame:
    """Rows that have a vector, with ``leader``: the arrival of the earliest similar leader.

    A leader is a row no earlier leader is similar to. Members are compared with the leader itself,
    not with a mean that moves while rows come in.
    """
    usable = materialize(
        rows.filter(F.size(vector) > 0).filter(F.exists(vector, lambda x: x != 0)), "cluster")
    leaders = materialize(keep_first_vectors(usable, threshold, vector, arrival, **limits).select(arrival), "leaders")
    cells = {k: v for k, v in limits.items() if k in ("cell_rows", "block")}
    led = assign_first(usable, leaders, threshold, vector, arrival, **cells)
    return usable.join(led.withColumnRenamed("arrival", arrival), arrival)


def cluster_means(members: DataFrame, vector: str = "embedding") -> DataFrame:
    """(leader, n, mean): the mean vector of each cluster, dimension by dimension."""
    entries = members.select("leader", F.posexplode(vector).alias("dim", "x")).groupBy("leader", "dim").agg(
        F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    return entries.groupBy("leader").agg(  # one entry per dimension
        F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"]).alias("mean"))


def cluster_spans(members: DataFrame, ts: str, cfg: Settings) -> DataFrame:
    """Largest clusters with size, first and last date."""
    return (
        members.groupBy("leader")
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"))
        .filter(F.col("n") >= cfg.cluster_min)
        .orderBy(F.col("n").desc(), "leader").limit(cfg.cluster_top)
    )


def timeline(members: DataFrame, spans: DataFrame, ts: str, arrival: str = "arrival", **limits) -> DataFrame:
    """Lines of the chosen clusters in time order: (leader, line_no, line). One row per line, any size."""
    chosen = members.join(F.broadcast(spans.select("leader")), "leader", "left_semi")  # a few rows
    lines = chosen.select("leader", F.col(ts).alias("_ts"), F.col(arrival).alias("_at"), F.concat(
        F.lit("- "), F.date_format(ts, "yyyy-MM-dd"), F.lit(" · "), F.col("title")).alias("line"))
    return running_sum(lines, ["leader"], ["_ts", "_at"], F.lit(1), "line_no", **limits).drop("_ts", "_at")


def narratives(spans: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Narrative rows from model answers (leader, thread_title, arc, implication), cut to length."""
    if answers is None:
        return spans.withColumns({
            "thread_title": F.lit(None).cast("string"), "arc": F.lit(None).cast("array<string>"),
            "implication": F.lit(None).cast("string")})
    return spans.join(answers, "leader").withColumns({
        "thread_title": F.left("thread_title", F.lit(24)),
        "arc": F.slice(F.coalesce("arc", F.array().cast("array<string>")), 1, 8),
        "implication": F.left("implication", F.lit(240)),
    })
