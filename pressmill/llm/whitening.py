"""Whitening of embeddings by an incremental eigendecomposition.

Every partition takes its rows one by one: the centred row is a rank-one term of the scatter matrix, whose eigenvalues are
the roots of a secular equation; directions that the row doesn't touch are deflated. Spectra of partitions are combined in
rounds, each eigenpair of the one being a rank-one term of the other, and one more term for the distance of the means.
Rayleigh-Ritz passes over all rows then refine the leading vectors: with the true covariance applied to a basis a little
wider than asked for, residuals beyond rounding widen the basis by corrections that the incremental spectrum preconditions.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries don't take part, nor do those of
another length than most; entries beyond +-2^40 before the offset count as that; a null id is kept; repeated rows each
count; components without variance are not returned (equal rows only: an empty result); a deviation beyond a long is null;
other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.spectrum import rank_one
from pressmill.llm.vectors import folded, numbered, scaled, usable

SCALE, OFFSET, LIMIT = 1024, 100_000, 1 << 40
COMPONENTS = 8
#: directions of the Ritz basis beyond the components asked for
EXTRA = 8
#: residual of a component, as a share of the largest eigenvalue, that counts as rounding
ROUNDING = 2e-14
PASSES = 16

SPECTRUM = "slot long, n long, sums array<long>, eigenvalues array<double>, basis array<double>"
PRODUCT = "slot long, trace double, total array<double>"
LONGS, DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
SPECTRUM_KINDS = {"n": pa.int64(), "sums": LONGS, "eigenvalues": DOUBLES, "basis": DOUBLES}
PRODUCT_KINDS = {"trace": pa.float64(), "total": DOUBLES}


class Shape:
    """How vectors of one length become integers."""

    def __init__(self, d: int, scale: int, offset: int):
        self.d, self.scale, self.offset = d, scale, offset

    def ints(self, column: pa.Array) -> np.ndarray:
        return scaled(column, self.d, self.scale, self.offset, LIMIT)


def _grown(shape: Shape):
    """The spectrum of one partition; vectors are taken relative to the offset, so that little is lost in their means."""
    def run(batches: Iterator[pa.RecordBatch]) -> dict:
        n, sums, mean = 0, np.zeros(shape.d, np.int64), np.zeros(shape.d)
        values, basis = np.zeros(0), np.zeros((shape.d, 0))
        for batch in batches:
            x = shape.ints(batch.column(0))
            sums += x.sum(axis=0)
            for row in (x - shape.offset).astype(np.float64):
                away = row - mean
                values, basis = rank_one(values, basis, away, n / (n + 1))
                n += 1
                mean += away / n
        return {"n": n, "sums": sums.tolist(), "eigenvalues": values.tolist(), "basis": basis.ravel().tolist()} if n else {}
    return numbered(run, SPECTRUM_KINDS)


def _combined(d: int):
    def run(parts: pd.DataFrame) -> dict:
        n, sums, values, basis = 0, [0] * d, np.zeros(0), np.zeros((d, 0))
        for part in parts.itertuples():
            more = np.asarray(part.eigenvalues, np.float64)
            vectors = np.asarray(part.basis, np.float64).reshape(d, len(more))
            theirs = [int(s) for s in part.sums]
            if n:
                # exact numerators of the distance of the means
                away = np.array([(b * n - a * int(part.n)) for a, b in zip(sums, theirs)], np.float64) / (float(n) * float(part.n))
                values, basis = rank_one(values, basis, away, n * (part.n / (n + part.n)))
                for k in range(len(more) - 1, -1, -1):
                    values, basis = rank_one(values, basis, vectors[:, k], max(more[k], 0.0))
            else:
                values, basis = more, vectors
            n, sums = n + int(part.n), [a + b for a, b in zip(sums, theirs)]
        return {"n": n, "sums": sums, "eigenvalues": values.tolist(), "basis": basis.ravel().tolist()}
    return run


class Centre:
    """Exact mean sums / n: the whole part is taken off the integers, the rest off what is left."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.over = np.array([s % n for s in sums], np.int64)

    def off(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.over / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sums)^2 of each row; null beyond a long."""
        far = x - self.whole
        rough = ((far * float(self.n) - self.over) ** 2).sum(axis=1)
        with np.errstate(over="ignore"):
            exact = far * self.n - self.over
            exact = (exact * exact).sum(axis=1)  # right below 2^63, where nothing wraps in the end
        out: list[int | None] = exact.tolist()
        for k in np.flatnonzero(rough > 9.2e18).tolist():
            slow = sum((int(a) * self.n - int(b)) ** 2 for a, b in zip(far[k], self.over))
            out[k] = slow if slow < 1 << 63 else None
        return out


def _applied(shape: Shape, centre: Centre, basis: np.ndarray):
    """Scatter matrix times ``basis``, and its trace, of one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> dict:
        total, trace, any_row = np.zeros(basis.shape), 0.0, False
        for batch in batches:
            y = centre.off(shape.ints(batch.column(0)))
            total += y.T @ (y @ basis)
            trace += float((y * y).sum())
            any_row |= len(y) > 0
        return {"trace": trace, "total": total.ravel().tolist()} if any_row else {}
    return numbered(run, PRODUCT_KINDS)


def _added(parts: pd.DataFrame) -> dict:
    return {"trace": float(parts["trace"].sum()), "total": np.sum([np.asarray(t) for t in parts["total"]], axis=0).tolist()}


def _refined(rows: DataFrame, shape: Shape, centre: Centre, values: np.ndarray, basis: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Leading eigenvalues (falling) and vectors of the covariance, and its trace."""
    trial = basis[:, ::-1][:, :k + EXTRA]
    best: tuple[float, np.ndarray, np.ndarray, float] | None = None
    for _ in range(PASSES):
        sums = folded(rows.mapInArrow(_applied(shape, centre, trial), PRODUCT), _added)
        image = np.array(sums["total"]).reshape(trial.shape) / centre.n
        trace = sums["trace"] / centre.n
        small = trial.T @ image
        e, turn = np.linalg.eigh((small + small.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        vectors, image = trial @ turn, image @ turn
        k = min(k, len(e))
        rest = image[:, :k] - vectors[:, :k] * e[:k]
        worst = float(np.sqrt((rest * rest).sum(axis=0)).max())
        settled = best is not None and worst >= best[0] / 2 and worst <= 1e-10 * e[0]  # no pass gets below rounding
        if best is None or worst < best[0]:
            best = worst, e[:k], vectors[:, :k], trace
        if settled or worst <= ROUNDING * e[0]:
            break
        ahead = np.subtract.outer(values / centre.n, e[:k])
        ahead = np.where(np.abs(ahead) < 1e-9 * e[0], 1e-9 * e[0], ahead)
        steps = basis @ ((basis.T @ rest) / ahead)
        wide = min(shape.d, vectors.shape[1] + k)
        trial = np.linalg.qr(np.column_stack([vectors, steps]))[0][:, :wide]
    return best[1], best[2], best[3]


def _squares(shape: Shape, centre: Centre, whiten: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> dict:
        total, any_row = np.zeros((whiten.shape[1],) * 2), False
        for batch in batches:
            w = centre.off(shape.ints(batch.column(0))) @ whiten
            total += w.T @ w
            any_row |= len(w) > 0
        return {"trace": 0.0, "total": total.ravel().tolist()} if any_row else {}
    return numbered(run, PRODUCT_KINDS)


def whitened(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
             scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per usable row and component: (id, component, n, deviation, whitened, explained, identity_error)."""
    spark = rows.sparkSession
    fields = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {fields}"
    empty = spark.createDataFrame([], schema)
    have, d = usable(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v")
    if not d:
        return empty
    shape, only = Shape(d, scale, offset), have.select("v")
    found = folded(only.mapInArrow(_grown(shape), SPECTRUM), _combined(d))
    values = np.array(found["eigenvalues"])
    basis = np.array(found["basis"]).reshape(d, len(values))
    centre = Centre(found["n"], found["sums"])
    if not len(values):
        return empty
    e, vectors, trace = _refined(only, shape, centre, values, basis, min(components, len(values)))
    keep = e > d * 1e-14 * trace
    if not keep.any():
        return empty
    e, vectors = e[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(e))])
    whiten = vectors * signs / np.sqrt(e)
    square = np.array(folded(only.mapInArrow(_squares(shape, centre, whiten), PRODUCT), _added)["total"])
    off = float(np.abs(square.reshape(len(e), len(e)) / centre.n - np.eye(len(e))).max())
    explained, k = e / trace, len(e)

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shape.ints(batch.column(1))
            w, m = centre.off(x) @ whiten, len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, centre.n)),
                pa.array([t for t in centre.deviation(x) for _ in range(k)], pa.int64()), pa.array(w.ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, off))], ["id", *[f.split()[0] for f in fields.split(", ")]])

    return have.select("id", "v").mapInArrow(result, f"id {kind}, {fields}").withColumnRenamed("id", id_col)
