"""URL expressions: canonical form, key, host."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

TRACKING_PARAM = "^(utm_|fbclid=|gclid=)"  # fixed value
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def canonical_url(url: Column) -> Column:
    """No fragment, no tracking parameters, no trailing slashes."""
    page = F.substring_index(strip(url), "#", 1)
    base = F.substring_index(page, "?", 1)
    query = F.substr(page, F.length(base) + 2)
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING_PARAM))
    with_query = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)
    whole = F.when(F.contains(page, F.lit("?")), with_query).otherwise(page)
    return F.regexp_replace(whole, "/+$", "")


def legacy_url(url: Column) -> Column:
    """The older rule, kept to find URLs on which the two rules disagree."""
    page = F.substring_index(url, "#", 1)
    return F.regexp_replace(F.substring_index(page, "?utm_", 1), "/+$", "")


def key_of(canonical: Column) -> Column:
    return F.left(F.sha2(canonical, 256), F.lit(16))


def url_key(canonical: Column, supplied: Column) -> Column:
    """A supplied key wins over the computed one."""
    return F.coalesce(F.nullif(supplied, F.lit("")), key_of(canonical))


def host(url: Column) -> Column:
    """Lower-cased authority (port and user info included); '' when there is none."""
    return F.lower(F.regexp_extract(url, _AUTHORITY, 1))
