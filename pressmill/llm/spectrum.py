"""Eigendecomposition of a scatter matrix that grows by rank-one terms."""
from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: rounds of the root finder; it needs four to eight, the rest is for bisection
ROUNDS = 100


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z', for rising distinct d, no zero in z, |z| = 1 and rho > 0, and the gaps d_j - value_i.

    Every root lies between two poles. It is sought as the distance from the nearer one, so that the gaps keep their relative
    precision, by steps on an interpolating rational function within a bracket, else by bisection.
    """
    n = len(d)
    square = z * z
    rows = np.arange(n)
    upper = np.append(d[1:], d[-1] + rho)
    half = (upper - d) / 2
    at_middle = 1 / rho + np.reciprocal(d - (d + half)[:, None]) @ square
    right = at_middle <= 0
    right[-1] = False
    origin = np.where(right, upper, d)
    low = np.where(right, -half, 0.0)
    high = np.where(right, 0.0, half)
    low[-1], high[-1] = 0.0, rho
    gaps = d - origin[:, None]
    before = np.minimum(rows, max(n - 2, 0))  # the two poles each step interpolates at
    after = np.minimum(before + 1, n - 1)
    below = (np.arange(n) <= before[:, None]).astype(np.float64)
    mu = (low + high) / 2
    last = rows == n - 1
    with np.errstate(all="ignore"):
        for _ in range(ROUNDS):
            inverse = np.reciprocal(gaps - mu[:, None])
            w = 1 / rho + inverse @ square
            done = np.abs(w) <= 16 * EPS * (1 / rho + np.abs(inverse) @ square)
            low, high = np.where(w < 0, mu, low), np.where(w < 0, high, mu)
            done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            slope = inverse * inverse
            left, whole = (slope * below) @ square, slope @ square
            one, two = gaps[rows, before] - mu, gaps[rows, after] - mu
            a = (one + two) * w - one * two * whole
            b = one * two * w
            c = w - one * left - two * (whole - left)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(last, np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root)),
                            np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root)))
            there = mu + step
            inside = (there > low) & (there < high) & np.isfinite(there)
            mu = np.where(done, mu, np.where(inside, there, (low + high) / 2))
        t = gaps - mu[:, None]
    return origin + mu, t


def _vectors(d: np.ndarray, z: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Eigenvectors from the gaps, with z computed anew from them, which makes the vectors orthogonal."""
    n = len(d)
    # root i pairs with pole i for the vectors beyond it and with pole i + 1 for the others; the last root then has none
    ratio = np.where(np.tri(n, dtype=bool), d - np.append(d[1:], 0.0)[:, None], d - d[:, None])
    ratio[-1] = 1.0
    exact = np.sqrt(np.abs(np.prod(t / ratio, axis=0))) * np.where(z < 0, -1.0, 1.0)
    out = exact[:, None] / t.T
    return out / np.sqrt((out * out).sum(axis=0))


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of basis diag(values) basis' + weight v v'; ``basis`` may span less than the space."""
    length = np.sqrt(v @ v)
    if not weight > 0 or not length > 0:
        return values, basis
    z = basis.T @ v
    rest = v - basis @ z
    again = basis.T @ rest
    z, rest = z + again, rest - basis @ again
    beyond = np.sqrt(rest @ rest)
    if beyond > 1e-13 * length and basis.shape[1] < len(v):
        values, basis, z = np.append(0.0, values), np.column_stack([rest / beyond, basis]), np.append(beyond, z)
        order = np.argsort(values, kind="stable")
        values, basis, z = values[order], basis[:, order], z[order]
    size = np.sqrt(z @ z)
    if not size > 0:
        return values, basis
    z, rho = z / size, weight * size * size
    tolerance = 8 * EPS * max(np.abs(values).max(), rho)
    moves = np.abs(rho * z) > tolerance  # deflation: a direction without a share in v stays as it is
    kept = np.flatnonzero(moves)
    if (np.diff(values[kept]) <= tolerance).any():  # deflation: of equal eigenvalues one takes the whole share
        values, basis, z = values.copy(), basis.copy(), z.copy()
        now = kept[0]
        for k in kept[1:].tolist():
            if values[k] - values[now] <= tolerance:
                r = np.hypot(z[now], z[k])
                c, s = z[k] / r, z[now] / r
                basis[:, [now, k]] = np.column_stack([c * basis[:, now] - s * basis[:, k], s * basis[:, now] + c * basis[:, k]])
                z[now], z[k] = 0.0, r
                moves[now] = False
            now = k
        kept = np.flatnonzero(moves)
    if not len(kept):
        return values, basis
    d, part = values[kept], z[kept]
    share = np.sqrt(part @ part)
    found, t = secular_roots(d, part / share, rho * share * share)
    turned = basis[:, kept] @ _vectors(d, part, t)
    values, basis = np.concatenate([values[~moves], found]), np.concatenate([basis[:, ~moves], turned], axis=1)
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]
