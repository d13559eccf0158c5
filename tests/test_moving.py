"""Clusters with moving means against the sequential loop."""
import math
import random

import pytest
from pyspark.sql import functions as F

from pressmill.operators.cluster import cluster_means
from pressmill.operators.moving import moving_clusters


def cosine(u, v):
    if len(u) != len(v) or any(x is None or math.isnan(x) for x in [*u, *v]):
        return 0.0
    nu, nv = math.sqrt(sum(x * x for x in u)), math.sqrt(sum(x * x for x in v))
    return sum(x * y for x, y in zip(u, v)) / (nu * nv) if 0 < nu < math.inf and 0 < nv < math.inf else 0.0


def loop(rows, threshold):
    """Leader of every row: the first cluster whose mean is similar, means moved by each new member."""
    clusters, out = [], {}
    for name, v in rows:
        if not v:
            continue
        for cluster in clusters:
            if cosine(v, cluster[1]) >= threshold:
                cluster[2] += 1
                cluster[1] = [(m * (cluster[2] - 1) + x) / cluster[2] for m, x in zip(cluster[1], v)]
                break
        else:
            cluster = [name, list(v), 1]
            clusters.append(cluster)
        out[name] = cluster[0]
    return out


def drifting(n, d, seed):
    """Random vectors around centres that wander, of unequal lengths, with copies."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        for k in range(d):
            centre[k] += rng.gauss(0, 0.15)
        scale = rng.choice([0.3, 1.0, 2.5])
        rows.append((i, list(rows[-1][1]) if rows and rng.random() < 0.1 else [scale * (c + rng.gauss(0, 0.6)) for c in centre]))
    return rows


@pytest.mark.parametrize("seed,d,threshold,limits", [
    (1, 3, 0.9, {}), (2, 3, 0.7, {"block": 25, "matches": 1}), (3, 8, 0.6, {"block": 40, "matches": 2, "task_means": 5, "moved": 10}),
    (4, 8, 0.3, {"block": 30, "matches": 2, "task_means": 7}), (5, 2, 0.99, {"block": 60, "matches": 3, "moved": 20})])
def test_equal_to_the_loop(spark, seed, d, threshold, limits):
    rows = drifting(240, d, seed)
    shuffled = random.Random(9).sample(rows, len(rows))
    frame = spark.createDataFrame([(v, i) for i, v in shuffled], "embedding array<double>, arrival long").repartition(3)
    got = {r["arrival"]: r["leader"] for r in moving_clusters(frame, threshold, **limits).collect()}
    want = loop(rows, threshold)
    assert got == want
    assert 1 < len(set(want.values())) < 200


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0, 0.1, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [0.9, 0.1]),
            (8, [0.0, 0.0]), (9, [1.0, 0.2, 0.0]), (10, [inf, 1.0]), (11, [1e-200, 0.0]), (12, [-1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "arrival long, vec array<double>, seq int, `my-col` string")
    found = moving_clusters(frame, 0.8, "vec", block=4)
    got = {r["arrival"]: r["leader"] for r in found.collect()}
    assert got == {0: 0, 1: 1, 4: 4, 5: 5, 6: 6, 7: 0, 8: 8, 9: 4, 10: 10, 11: 11, 12: 12}
    assert set(found.columns) == {"arrival", "vec", "seq", "my-col", "leader"}
    assert moving_clusters(frame.limit(0), 0.8, "vec").count() == 0
    assert moving_clusters(frame.where("arrival = 2"), 0.8, "vec").count() == 0


def test_means(spark):
    members = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])], "leader long, embedding array<double>")
    assert sorted((r["leader"], r["n"], r["mean"]) for r in cluster_means(members).collect()) == [(1, 2, [2.0, 3.0]), (2, 1, [5.0, 5.0])]


def test_far_means_are_left_out():
    """Of many tight groups of means, a block compares its rows with those around a few pivots only."""
    import numpy as np

    from pressmill.operators import moving

    rng = np.random.default_rng(3)
    centres = moving._units(rng.normal(size=(60, 32)))
    means = moving._units(np.repeat(centres, 50, axis=0) + rng.normal(size=(3000, 32)) * 0.01)
    rows = moving._units(centres[:5] + rng.normal(size=(5, 32)) * 0.01)
    i, j = moving._reached(rows, means, 0.95)
    a, b = np.nonzero(rows @ means.T >= 0.95)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist())) and len(i) == 250
