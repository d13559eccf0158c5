"""Vector expressions for single rows and given pairs."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(u: Column, v: Column) -> Column:
    return F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda a, x: a + x)


def norm(u: Column) -> Column:
    return F.sqrt(F.aggregate(u, F.lit(0.0).cast("double"), lambda a, x: a + x * x))


def cosine(u: Column, v: Column, norm_u: Column | None = None, norm_v: Column | None = None) -> Column:
    """0 for vectors of unequal length, empty vectors and zero vectors."""
    nu = norm(u) if norm_u is None else norm_u
    nv = norm(v) if norm_v is None else norm_v
    fits = (F.size(u) == F.size(v)) & (nu > 0) & (nv > 0)
    return F.when(fits, dot(u, v) / (nu * nv)).otherwise(F.lit(0.0))


def running_mean(mean: Column, v: Column, n: Column) -> Column:
    """Mean of n vectors from the mean of the first n-1 and the n-th."""
    return F.zip_with(mean, v, lambda m, x: (m * (n - 1) + x) / n)
