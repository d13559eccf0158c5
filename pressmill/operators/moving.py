"""Story clusters with means that move: first fit in arrival order, each row against the means as they stand.

Sequentially: a row joins the first cluster (in the order they began) whose mean is similar enough, and moves that mean; a row
that fits none begins a cluster. Rows are decided in blocks of bounded size. All rows of a block are first compared with the
means as they stood before the block, in parallel; each keeps its first few matches. One task then goes through the block: a
mean can only have moved if a row of the block joined it, so what counts are the moved and the new means, compared anew, and
the first match of the row that has not moved. Where all kept matches of a row have moved and more may follow, the block is
cut before that row, and the next one begins there. The first row of a block meets nothing that has moved, so every block
decides at least one row, and the result is that of the sequential loop.

A task that compares a block with some means groups these around a few of them and, by the triangle inequality of angles,
leaves out groups a row can't reach, so work follows the number of means near a row. Means live in a written table; blocks
append the means they moved, and the table is written anew when these are many.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import norm
from ..session import materialize
from .layout import chunked, running_over_chunks

BLOCK = 8192
#: matches a row keeps
MATCHES = 8
#: means that one task compares with a block
TASK_MEANS = 32_768
#: moved means beside the table; their names are broadcast
MOVED = 65_536

FOUND = "seq long, leader long, n long, total array<double>"
STEP = "seq long, leader long, n long, total array<double>"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.asarray(vectors.tolist(), dtype=np.float64)


def _units(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _reached(rows: np.ndarray, means: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, mean) of unit vectors that are similar, means around a few pivots."""
    n = len(means)
    pivots = means[np.linspace(0, n - 1, max(1, math.isqrt(n))).astype(int)]
    near = np.clip(means @ pivots.T, -1, 1)
    own = near.argmax(axis=1)
    radius = np.zeros(len(pivots))
    np.maximum.at(radius, own, np.arccos(near[np.arange(n), own]))
    reach = np.arccos(np.clip(rows @ pivots.T, -1, 1)) <= radius + math.acos(max(-1.0, min(1.0, threshold))) + 1e-7
    left, right = [], []
    for p in range(len(pivots)):
        members, asking = np.flatnonzero(own == p), np.flatnonzero(reach[:, p])
        if len(members) and len(asking):
            i, j = np.nonzero(rows[asking] @ means[members].T >= threshold)
            left.append(asking[i])
            right.append(members[j])
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def _numbers(lists: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = np.concatenate([np.asarray(chunk.flatten()) for chunk in lists.chunks])
    return flat.reshape(len(lists), -1)


def _search(threshold: float, matches: int):
    """First matches of the rows of a block among the means of one task, then once each mean that is one (``seq`` null)."""
    shape = pa.schema([("seq", pa.int64()), ("leader", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def run(rows: pa.Table, means: pa.Table) -> pa.Table:
        if not rows.num_rows or not means.num_rows:
            return shape.empty_table()
        means = means.sort_by("leader")
        i, j = _reached(_units(_numbers(rows["vector"])), _units(_numbers(means["total"])), threshold)
        order = np.lexsort([j, i])
        i, j = i[order], j[order]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < matches
        i, j = i[keep], j[keep]
        pairs = pa.table({"seq": np.asarray(rows["seq"])[i], "leader": np.asarray(means["leader"])[j],
                          "n": pa.nulls(len(i), pa.int64()), "total": pa.nulls(len(i), pa.list_(pa.float64()))}, shape)
        met = means.take(np.unique(j))
        return pa.concat_tables([pairs, pa.table({"seq": pa.nulls(met.num_rows, pa.int64()), "leader": met["leader"], "n": met["n"],
                                                  "total": met["total"].cast(pa.list_(pa.float64()))}, shape)])
    return run


def _resolve(threshold: float, matches: int):
    """Goes through one block: the leader of each decided row, and the means that moved (``seq`` null)."""
    def run(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        vectors = _matrix(rows["vector"])
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        listed: dict[int, list[int]] = {}
        frozen: dict[int, tuple[int, np.ndarray]] = {}
        if len(found):
            means = found[found["seq"].isna()]
            frozen = {leader: (n, np.asarray(total, dtype=np.float64))
                      for leader, n, total in zip(means["leader"].tolist(), means["n"].astype("int64").tolist(), means["total"])}
            pairs = found.loc[found["seq"].notna(), ["seq", "leader"]].astype("int64").sort_values(["seq", "leader"])
            pairs = pairs[pairs.groupby("seq").cumcount() < matches]
            for seq, leader in zip(pairs["seq"].tolist(), pairs["leader"].tolist()):
                listed.setdefault(seq, []).append(leader)
        count, place = 0, {}
        leaders = np.empty(len(rows), np.int64)
        totals, sizes, members = np.empty_like(vectors), np.empty(len(rows)), np.zeros(len(rows), np.int64)
        decided: list[int] = []
        for at, seq in enumerate(rows["seq"].tolist()):
            v = vectors[at]
            fits = totals[:count] @ v >= threshold * (sizes[:count] * lengths[at])
            best = int(leaders[:count][fits].min()) if fits.any() else None
            mine = listed.get(seq, [])
            still = next((leader for leader in mine if leader not in place), None)
            if still is None and len(mine) == matches and (best is None or best > mine[-1]):
                break  # there may be a match that was not kept
            if still is not None and (best is None or still < best):
                best = still
            if best is None:
                best = seq
            if best not in place:
                n, total = frozen.get(best, (0, 0.0))
                place[best], leaders[count], members[count], totals[count] = count, best, n, total
                count += 1
            k = place[best]
            totals[k] += v
            members[k] += 1
            sizes[k] = math.sqrt(totals[k] @ totals[k])
            decided.append(best)
        n_decided, none = len(decided), [None] * len(decided)
        return pd.DataFrame({
            "seq": pd.array([*rows["seq"].tolist()[:n_decided], *[None] * count], "Int64"),
            "leader": [*decided, *leaders[:count].tolist()],
            "n": pd.array([*none, *members[:count].tolist()], "Int64"),
            "total": pd.Series([*none, *totals[:count]], dtype=object)})
    return run


def _clusters_of_one_length(rows: DataFrame, threshold: float, block: int, matches: int, task_means: int, moved_limit: int) -> DataFrame:
    """(seq, leader) of rows (seq, vector), both with the numbers of ``seq``."""
    spark = rows.sparkSession
    low, last = rows.agg(F.min("seq"), F.max("seq")).first()
    steps: list[DataFrame] = []
    table, recent, n_table, n_recent, version = None, None, 0, 0, 0
    one = F.lit(0).alias("one")
    while low <= last:
        own = rows.where((F.col("seq") >= low) & (F.col("seq") < low + block))
        if table is None:
            found = spark.createDataFrame([], FOUND)
        else:
            tasks = max(1, -(-(n_table + n_recent) // task_means))
            asked = own.select("seq", "vector").withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
            now = table if recent is None else table.join(F.broadcast(recent.select("leader")), "leader", "left_anti").unionByName(recent)
            dealt = now.withColumn("task", F.pmod(F.xxhash64("leader"), F.lit(tasks)).cast("int"))
            found = asked.groupBy("task").cogroup(dealt.groupBy("task")).applyInArrow(_search(threshold, matches), FOUND)
        # one block and its matches, both bounded, meet in one task
        step = materialize(own.groupBy(one).cogroup(found.groupBy(one)).applyInPandas(_resolve(threshold, matches), STEP), "block")
        decided = step.where("seq IS NOT NULL").select("seq", "leader")
        steps.append(decided)
        done = decided.agg(F.max("seq")).first()[0]
        low = low + block if done is None else done + 1  # none: rows of another length only
        if low > last or done is None:
            continue
        version += 1
        moved = step.where("seq IS NULL").select("leader", "n", "total", F.lit(version).cast("long").alias("version"))
        recent = moved if recent is None else recent.join(F.broadcast(moved.select("leader")), "leader", "left_anti").unionByName(moved)
        n_recent = recent.count()
        if table is None or n_recent > moved_limit:
            whole = recent if table is None else table.join(recent.select("leader"), "leader", "left_anti").unionByName(recent)
            table, recent = materialize(whole, "means"), None
            n_table, n_recent = table.count(), 0
        elif version % 8 == 0:
            recent = materialize(recent, "moved")
    out = steps[0]
    for more in steps[1:]:
        out = out.unionByName(more)
    return out


def moving_clusters(
    rows: DataFrame, threshold: float, vector: str = "embedding", arrival: str = "arrival", block: int = BLOCK, matches: int = MATCHES,
    task_means: int = TASK_MEANS, moved: int = MOVED,
) -> DataFrame:
    """Rows that have a vector, with ``leader``: the arrival of the first row of their cluster. ``threshold`` is above zero.

    Vectors of unequal length are never similar. A vector that holds null or NaN, or whose norm is zero or infinite, is similar
    to nothing and is a cluster of its own. Equal arrivals are taken in any order; rows without an arrival come first.
    """
    values = F.col(vector).cast("array<double>")
    length = norm(F.col("vector"))
    usable = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)) & (length > 0) & (length < float("inf"))
    have = rows.filter(F.size(vector) > 0).withColumn("_vector", values)
    laid_out = chunked(have, [], [arrival])
    numbered = running_over_chunks(laid_out, [], F.lit(1), "_seq").drop("chunk", "pos")
    # in order, so that a block reads the row groups that hold it
    numbered = materialize(numbered.repartitionByRange("_seq").sortWithinPartitions("_seq"), "numbered")
    plain = numbered.select(F.col("_seq").cast("long").alias("seq"), F.col("_vector").alias("vector"))
    kinds = plain.where(usable).groupBy(F.size("vector").alias("d")).count().collect()  # one row per length that occurs
    led = plain.where(~F.coalesce(usable, F.lit(False))).select("seq", F.col("seq").alias("leader"))
    for kind in kinds:
        same = plain.where(usable & (F.size("vector") == kind["d"]))
        led = led.unionByName(_clusters_of_one_length(same, threshold, block, matches, task_means, moved))
    led = materialize(led, "led")
    heads = numbered.select(F.col("_seq").cast("long").alias("leader"), F.col(arrival).alias("_head")).join(
        led.select("leader").distinct(), "leader", "left_semi")
    named = led.join(heads, "leader").select(F.col("seq").alias("_seq"), F.col("_head").alias("leader"))
    return numbered.drop("_vector").join(named, "_seq").drop("_seq")
