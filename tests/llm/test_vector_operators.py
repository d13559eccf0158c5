"""Whitening and hard negatives against plain versions."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm import negatives, queries, spectrum
from pressmill.llm.negatives import hard_negatives
from pressmill.llm.whitening import whitened

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_rank_one_updates_equal_a_whole_decomposition(d):
    rng = np.random.default_rng(d)
    x = np.floor(rng.normal(size=(3 * d + 8, d)) * 100)
    x[2:5] = x[0]  # equal rows
    x[6] = 0
    x[7] = 1e-9 * x[1]  # hardly any length
    values, basis, total = np.zeros(0), np.zeros((d, 0)), np.zeros((d, d))
    for k, row in enumerate(x):
        weight = [1.0, 0.25, 3.0][k % 3]
        values, basis = spectrum.rank_one(values, basis, row, weight)
        total += weight * np.outer(row, row)
    assert (np.diff(values) >= 0).all()
    assert np.allclose(values, np.linalg.eigvalsh(total)[-len(values):], rtol=0, atol=1e-12 * values[-1])
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-12
    assert np.abs(basis * values @ basis.T - total).max() < 1e-12 * values[-1]


def test_equal_eigenvalues_and_untouched_directions_are_deflated():
    values, basis = spectrum.rank_one(np.full(6, 4.0), np.eye(6), np.array([1.0, 2.0, 0, 0, 0, 2.0]), 1.0)
    assert np.allclose(values, [4, 4, 4, 4, 4, 13], atol=1e-13)
    assert np.allclose(np.abs(basis[:, -1]), np.array([1, 2, 0, 0, 0, 2]) / 3, atol=1e-13)
    same = spectrum.rank_one(values, basis, np.zeros(6), 1.0)
    assert same[0] is values and same[1] is basis


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x.astype(object) - s) ** 2).sum(axis=1), y @ q / np.sqrt(e), e / np.trace(y.T @ y / n)


def by_row(frame, id_col="vec_id"):
    out = {}
    for r in frame.collect():
        out.setdefault(r[id_col], []).append(r)
    return {k: sorted(v, key=lambda r: r.component) for k, v in out.items()}


@pytest.mark.parametrize("parts", [1, 5])
def test_whitening_equals_a_plain_decomposition(spark, parts):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, white, explained = plain_whitening([r.embedding for r in rows])
    got = by_row(whitened(spark.createDataFrame(rows, VECTORS).repartition(parts)))
    assert len(got) == len(rows)
    found = np.array([[r.whitened for r in got[k.vec_id]] for k in rows])
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found * sign - white).max() < 1e-9
    assert [got[k.vec_id][0].deviation for k in rows] == list(deviation)
    first = got[rows[0].vec_id]
    assert [r.component for r in first] == list(range(1, 9)) and {r.n for r in first} == {n}
    assert np.allclose([r.explained for r in first], explained, rtol=1e-10)
    assert 0 <= first[0].identity_error < 1e-9


def test_whitening_takes_what_the_spectrum_gives(spark, monkeypatch):
    """A wrong spectrum costs passes; the refinement still ends at the same vectors."""
    from pressmill.llm import whitening

    passes = []
    folded = whitening.folded
    monkeypatch.setattr(whitening, "folded", lambda *a: passes.append(1) or folded(*a))
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    right = {(r.vec_id, r.component): abs(r.whitened) for r in whitened(table).collect()}
    cost = len(passes)
    refined = whitening._refined
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(64, 64)))[0]
    monkeypatch.setattr(whitening, "_refined", lambda rows, shape, centre, values, basis, k: refined(rows, shape, centre, values, turn, k))
    passes.clear()
    wrong = whitened(table).collect()
    assert cost <= 5 < len(passes)
    assert all(abs(abs(r.whitened) - right[r.vec_id, r.component]) < 1e-8 for r in wrong) and len(wrong) == len(right)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 3.0], [2.0, 1.0, 0.0], [2.0, 1.0, 0.0], [5.0, -1.0, 2.0], [0.5, 0.25, 9.0]]
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [-inf, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "x", 7) for i, v in enumerate(good)] + [(100 + i, v, "y", 7) for i, v in enumerate(bad)] + [(None, [4.0, 4.0, 4.0], "z", 7)]
    frame = spark.createDataFrame(rows, "`my-id` long, vec array<double>, component string, n int").repartition(3)
    got = by_row(whitened(frame, "my-id", "vec"), "my-id")
    assert sorted(got, key=str) == sorted([0, 1, 2, 3, 4, None], key=str)
    n, deviation, white, _ = plain_whitening([*good, [4.0, 4.0, 4.0]], 3)
    assert {r.n for v in got.values() for r in v} == {n} and [got[i][0].deviation for i in range(5)] == list(deviation[:5])
    assert np.allclose(np.abs([r.whitened for r in got[None]]), np.abs(white[5]), atol=1e-9)
    assert [r.whitened for r in got[1]] == [r.whitened for r in got[2]]  # repeated rows
    one = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(6)], "vec_id long, embedding array<double>")
    assert {len(v) for v in by_row(whitened(one)).values()} == {1}  # one direction only
    huge = [(i, [1e8 * i, float(i % 3)]) for i in range(1, 40)]
    assert {r.deviation for r in whitened(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()} >= {None}
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3):
        assert whitened(spark.createDataFrame(rows, VECTORS)).count() == 0


def plain_negatives(rows, positives=5, negatives_=3, divisor=50):
    rows = [(i, v, lab) for i, v, lab in rows if lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    rows = [(i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows]
    last = float("inf")

    def first(found, n):
        return sorted(found, key=lambda f: (-f[0], last if f[1] is None else f[1]))[:n]

    out = []
    for a, (i, v, lab) in enumerate(rows):
        if i is None or i % divisor:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(rows) if b != a]
        for ps, p, _ in first([s for s in scores if s[2] == lab], positives):
            fits = [s for s in scores if s[2] != lab and 50 * ps <= 100 * s[0] <= 95 * ps]
            out += [(i, p, k + 1, j, ps, ns) for k, (ns, j, _) in enumerate(first(fits, negatives_))]
    return sorted(out, key=str)


@pytest.mark.parametrize("d,levels,block", [(3, 2, 4096), (64, 6, 4096), (70, 3, 4)])
def test_hard_negatives_equal_all_pairs(spark, d, levels, block):
    rng = random.Random(d)
    centres = [[rng.gauss(0, 0.2) for _ in range(d)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.randrange(3)) for i in range(240)]
    rows += [(i, rows[0][1], rows[0][2]) for i in (0, 7, 50, 300)] + [(None, rows[1][1], 1), (None, rows[1][1], 2)]  # copies, null ids
    rows += [(400, None, 1), (401, rows[2][1], None), (450, [float("nan")] * d, 1), (452, [None] * d, 1), (453, [], 1), (454, [float("inf")] * d, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = hard_negatives(frame, F.col("vec_id") % 10 == 0, levels=levels, block=block).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain_negatives(rows, divisor=10)
    assert len(got) > 60


def test_intervals_hold_every_score_and_leave_rows_out():
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(size=(400, 64)) / 8).astype(np.int64)
    bits, align = negatives.encode(v, negatives.LEVELS)
    estimate, off = negatives.Planes(v[:40], negatives.LEVELS).intervals(np.arange(40), bits, align)
    exact = v @ v[:40].T
    assert (np.abs(estimate - exact) <= off).all()
    assert off.mean() < 0.1 * 65536  # of vectors of length 256: scores are known to a tenth of the largest
    assert np.allclose((negatives.rotate(v.astype(float), 3) ** 2).sum(axis=1), (v * v).sum(axis=1))


def test_hard_negatives_of_odd_tables(spark):
    for rows in ([], [(0, None, 1)], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(3, [1.0], 1), (1, [1.0], 1)]):
        assert hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).count() == 0
    more = spark.createDataFrame([(0, [2.0], 1, 5, "x"), (1, [2.0], 1, 6, "y"), (2, [1.5], 2, 7, "z")],
                                 "vec_id long, embedding array<float>, label int, `row` int, `my-code` string")
    assert [tuple(r) for r in hard_negatives(more, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 2, 512 * 512, 512 * 384)]


def test_query_moves_labels(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    got = sorted([tuple(r) for r in queries.op13_hard_negatives(spark, SMALL).collect()], key=str)
    assert got == plain_negatives(rows)
