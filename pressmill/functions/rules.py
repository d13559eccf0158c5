"""Rule tables as expressions: first match wins, tags, bands, defaults."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import any_of


def first_match(hay: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    chain = None
    for label, keywords in rules:
        test = any_of(hay, keywords)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def tags(hay: Column, rules: list[tuple[str, str]], default: str, most: int = 5) -> Column:
    found = F.array_distinct(F.array_compact(F.array(
        *[F.when(F.contains(hay, F.lit(k.lower())), F.lit(tag)) for k, tag in rules]
    )))
    return F.when(F.size(found) > 0, F.slice(found, 1, most)).otherwise(F.array(F.lit(default)))


def valid_or(value: Column, known: list[str], default: str) -> Column:
    return F.when(value.isin(known), value).otherwise(default)


def band(velocity: Column) -> Column:
    return F.when(velocity > 0.5, "up").when(velocity < -0.2, "down").otherwise("flat")
