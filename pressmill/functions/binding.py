"""Columns that are computed once per row, whatever is built on them."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns behind a one-row generator.

    The optimizer copies the definition of a projected column into every filter and projection above
    it. For a text that dozens of keyword tests look at this means dozens of evaluations per row; a
    generator output is not copied.
    """
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))
