"""Similarity operators against plain sequential loops."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.functions.text import words
from pressmill.functions.titles import indel, similar_words, token_set_ratio
from pressmill.operators.cluster import cluster_spans, clustered, timeline
from pressmill.operators.title_join import keep_first_titles
from pressmill.operators.vector_join import keep_first_vectors, not_near
from pressmill.params import Settings


def indel_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    """The token-set ratio as publicly documented, without shortcuts."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not one or not two):
        return 100.0
    full_1, full_2 = f"{both} {one}".strip(), f"{both} {two}".strip()

    def r(s, t):
        return 100.0 - 100.0 * indel_table(s, t) / (len(s) + len(t))
    dist = indel_table(one, two)
    best = 100.0 - 100.0 * dist / (len(full_1) + len(full_2))
    return max(best, r(both, full_1), r(both, full_2)) if both else best


def keep_loop(items, similar):
    kept = []
    for i, x in enumerate(items):
        if not any(similar(items[k], x) for k in kept):
            kept.append(i)
    return kept


def test_indel():
    rng = random.Random(1)
    for _ in range(300):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))
        d = indel_table(a, b)
        assert indel(a, b) == d
        for limit in (0, 3, 10, 30):
            got = indel(a, b, limit)
            assert got == d if d <= limit else got > limit


def made_titles(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    titles = ["", "", "colour", "color", "internationalisation", "internationalization", "foo bar", "foobar"]
    while len(titles) < n:
        if len(titles) > 10 and rng.random() < 0.55:
            base = rng.choice(titles)
            kind = rng.random()
            if kind < 0.3:  # typing errors
                chars = list(base)
                for _ in range(rng.randint(1, 3)):
                    if chars:
                        chars[rng.randrange(len(chars))] = rng.choice(["", "x", "yz", " "])
                titles.append("".join(chars))
            elif kind < 0.6:  # more words
                titles.append(base + " " + rng.choice(vocabulary))
            else:  # other order, fewer words
                parts = base.split()
                rng.shuffle(parts)
                titles.append(" ".join(parts[: max(1, len(parts) - rng.randint(0, 1))]))
        else:
            titles.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9))))
    return titles


@pytest.mark.parametrize("threshold", [92.0, 80.0, 100.0])
def test_similar_words_is_the_ratio(threshold):
    titles = [t for t in made_titles(90, 5) if t.split()]
    for a in titles:
        for b in titles:
            x, y = (" ".join(sorted(set(t.split()))) for t in (a, b))
            assert similar_words(x, y, threshold) == (ratio(a, b) >= threshold), (a, b)


def test_ratio_expression(spark):
    pairs = [("a b c", "c b"), ("color", "colour"), ("", "x"), ("new model out now", "new model out today"), ("ab", "cd")]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", token_set_ratio(words(F.col("a")), words(F.col("b"))).alias("r"))
    for row in df.collect():
        assert row["r"] == pytest.approx(ratio(row["a"], row["b"]))


@pytest.mark.parametrize("threshold, seed, batches", [
    (92.0, 1, {}), (92.0, 2, {"first_batch": 20, "growth": 3}), (85.0, 3, {"limit": 5}), (100.0, 4, {})])
def test_titles_keep_first(spark, threshold, seed, batches):
    titles = made_titles(160, seed)
    df = spark.createDataFrame(list(enumerate(titles)), "arrival long, title string")
    got = sorted(r["arrival"] for r in keep_first_titles(df, threshold, **batches).collect())
    assert got == keep_loop(titles, lambda a, b: ratio(a, b) >= threshold)


def test_hot_group_of_near_copies(spark):
    titles = [f"big story of the day told again {i}" for i in range(120)] + [f"own{i} words{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(titles)), "arrival long, title string")
    got = sorted(r["arrival"] for r in keep_first_titles(df, 92.0, limit=10, first_batch=16, growth=2).collect())
    assert got == keep_loop(titles, lambda a, b: ratio(a, b) >= 92.0)


def made_vectors(n, seed, dim=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = [centers[rng.integers(6)] + rng.normal(scale=0.5, size=dim) for _ in range(n)]
    rows[5], rows[9] = np.zeros(dim), np.zeros(dim)
    rows[12] = rows[3]
    return [r.tolist() for r in rows]


def cosine(u, v):
    u, v = np.array(u), np.array(v)
    nu, nv = np.linalg.norm(u), np.linalg.norm(v)
    return float(u @ v / nu / nv) if nu and nv else 0.0


@pytest.mark.parametrize("threshold, options", [
    (0.88, {}), (0.6, {"block": 16}), (0.88, {"block": 8, "cell_rows": 20, "first_batch": 30, "growth": 2}),
    (0.3, {"block": 8, "cell_rows": 20})])
def test_vectors_keep_first(spark, threshold, options):
    rows = made_vectors(150, 7)
    df = spark.createDataFrame(list(enumerate(rows)), "arrival long, embedding array<double>")
    df = df.unionByName(spark.createDataFrame([(900, None), (901, [])], df.schema))
    got = sorted(r["arrival"] for r in keep_first_vectors(df, threshold, **options).collect())
    assert got == keep_loop(rows, lambda a, b: cosine(a, b) >= threshold) + [900, 901]


def test_not_near(spark):
    new, old = made_vectors(80, 1), made_vectors(60, 2)
    a = spark.createDataFrame(list(enumerate(new)), "arrival long, embedding array<double>")
    b = spark.createDataFrame([(v,) for v in old], "embedding array<double>")
    for options in ({}, {"block": 8, "cell_rows": 15}):
        got = sorted(r["arrival"] for r in not_near(a, b, 0.7, **options).collect())
        assert got == [i for i, v in enumerate(new) if not any(cosine(v, w) >= 0.7 for w in old)]


def test_clusters(spark):
    rows = made_vectors(120, 3)
    df = spark.createDataFrame([(i, v, f"t{i}", f"2024-01-{i % 28 + 1:02d}") for i, v in enumerate(rows)],
                               "arrival long, embedding array<double>, title string, day string")
    df = df.withColumn("ts", F.to_timestamp("day"))
    members = clustered(df, 0.78, block=16, cell_rows=40)
    usable = [i for i, v in enumerate(rows) if any(v)]
    leaders, want = [], {}
    for i in usable:
        lead = next((k for k in leaders if cosine(rows[k], rows[i]) >= 0.78), None)
        if lead is None:
            leaders.append(i)
        want[i] = i if lead is None else lead
    assert {r["arrival"]: r["leader"] for r in members.collect()} == want
    spans = cluster_spans(members, "ts", Settings())
    sizes = {k: list(want.values()).count(k) for k in set(want.values())}
    best = sorted((k for k in sizes if sizes[k] >= 3), key=lambda k: (-sizes[k], k))[:3]
    assert [(r["leader"], r["n"]) for r in spans.collect()] == [(k, sizes[k]) for k in best]
    lines = timeline(members, spans, "ts", group_limit=5, chunks=3).collect()
    for k in best:
        own = sorted((i % 28 + 1, i) for i in want if want[i] == k)
        assert [r["line"] for r in sorted((r for r in lines if r["leader"] == k), key=lambda r: r["line_no"])] == [
            f"- 2024-01-{d:02d} · t{i}" for d, i in own]
