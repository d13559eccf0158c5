"""Timestamps: parsing and age. The reference time is always a parameter."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: dt.datetime | str | Column) -> Column:
    """A literal instant; text without an offset is UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    micros = round((value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))
    return F.timestamp_micros(F.lit(micros))


def parse_iso(s: Column) -> Column:
    """ISO text with a whole date, offset or Z; junk, '' and a time or month alone give null."""
    return F.when(s.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(s))


def parse_feed_date(s: Column) -> Column:
    """RFC 822 date of a feed entry, else ISO; the weekday is not needed and is cut off."""
    plain = F.regexp_replace(F.trim(s), r"^[A-Za-z]+,\s*", "")
    plain = F.regexp_replace(plain, r"\b(UT|UTC|Z)$", "GMT")
    zoned = F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss z"))
    offset = F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))
    return F.coalesce(zoned, offset, parse_iso(s))


def age_hours(ts: Column, as_of: Column) -> Column:
    """Hours from ``ts`` to ``as_of``, never negative."""
    return F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(3.6e9))


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.expr(f"INTERVAL '{int(days)}' DAY")
