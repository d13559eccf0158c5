"""Secret scans with corpus-wide ownership, in built-in functions only.

Patterns give candidate spans. Hashes of their values are counted over the corpus by distinct repository and distinct
owner: a value that many owners carry is an example or a test key; one that belongs to few owners and looks generated is
live. Each candidate value gets a further span, ``example`` or ``live``. Values themselves are never stored.

Defined results: a null text is empty; a null repository or owner counts as one unnamed one; repeated rows each get a
row; without rows there are none; positions are code points, ends exclusive.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.session import materialize

#: kind, pattern, group that holds the value, least length of the value
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
ORDER = ("assign", "access", "hex", "example", "live")
#: a value of more owners or repositories than this is widely copied
MAX_OWNERS = 2
MAX_REPOSITORIES = 3
LIVE_LENGTH = 16


def _looks_generated(value: Column) -> Column:
    return (F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(r"(.)\1{5}")


def _parts(text: Column, pattern: str, group: int) -> Column:
    """For each match: code points since the last match, its length, its value's length and hash, whether it looks generated."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.struct(
        F.length(v).alias("size"), F.sha2(v, 256).alias("hash"), _looks_generated(v).alias("generated")))
    matches = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    return F.when(text.rlike(pattern), matches)


def _spans(rows: DataFrame) -> DataFrame:
    """One row per kept match: row, repository, owner, kind, start, end, value_start, hash, generated."""
    found = None
    for kind, _, _, least in PATTERNS:
        at = Window.partitionBy("row").orderBy("pos")
        one = rows.where(F.size(kind) > 0).select("row", "repository", "owner", F.posexplode(kind).alias("pos", "m"))
        end = F.sum(F.col("m.gap") + F.col("m.whole")).over(at)
        one = one.select("row", "repository", "owner", F.lit(kind).alias("kind"), "m", end.alias("end")).where(F.col("m.value.size") >= least)
        one = one.select("row", "repository", "owner", "kind", (F.col("end") - F.col("m.whole")).alias("start"), "end",
                         (F.col("end") - F.col("m.value.size")).alias("value_start"), F.col("m.value.hash").alias("hash"),
                         F.col("m.value.generated").alias("generated"))
        found = one if found is None else found.unionByName(one)
    return found


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, repositories, owners): distinct counts. Pairs are made distinct first, so a value in a third of all rows moves once per task."""
    def distinct(column: str, name: str) -> DataFrame:
        return spans.select("hash", column).distinct().groupBy("hash").agg(F.count(F.lit(1)).alias(name))

    return distinct("repository", "repositories").join(distinct("owner", "owners"), "hash")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "source", owner_col: str = "source",
                 max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: id and spans, an array of (start, rank, end, kind) in order of start and kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = {n: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("repository", repository_col), ("owner", owner_col))}
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), *named.values(),
                                   *[_parts(text, p, g).alias(k) for k, p, g, _ in PATTERNS]), "secrets")
    spans = materialize(_spans(rows), "spans")
    owners = materialize(ownership(spans), "owners")
    wide = (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories) | ~F.col("generated")
    judged = spans.join(owners, "hash").select(
        "row", F.when(wide, "example").otherwise("live").alias("kind"), F.col("value_start").alias("start"), "end").distinct()
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind"))
    both = spans.select("row", "kind", "start", "end").unionByName(judged)
    of_row = both.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>")
    return rows.select("row", F.col("id").alias(id_col)).join(of_row, "row", "left").select(id_col, F.coalesce("spans", none).alias("spans"))
