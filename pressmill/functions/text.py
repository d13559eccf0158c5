"""Text expressions: whitespace, tokens, sizes, embedded JSON, HTML."""
from __future__ import annotations

import html.parser

import pandas as pd
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from ..params import REASON_FROM, REASON_JOIN, REASON_SAMPLE, STOPWORDS_EN, STOPWORDS_ZH

# All characters that count as white space, spelled out because regex dialects disagree on \s.
WHITESPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set for Java's engine, arranged so that a letter fails after two tests.
_SPACES = (
    r"(?:[\t\n\x{b}\f\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}]"
    r"|(?=[\x{1680}-\x{3000}])[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])+"
)
TOKEN_PATTERN = r"[A-Za-z][A-Za-z\-]+|[\x{4e00}-\x{9fa5}]{2,}"  # fixed value
CJK_PATTERN = r"[\x{4e00}-\x{9fff}]"  # fixed value, wider than the range of tokens


def strip(s: Column) -> Column:
    return F.regexp_replace(s, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def squeeze(s: Column) -> Column:
    """One blank between words, none at the ends, '' for null."""
    return F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), _SPACES, " "))


def words(s: Column) -> Column:
    """Distinct white-space separated words, sorted."""
    return F.array_sort(F.array_distinct(F.array_remove(F.split(squeeze(s), " "), "")))


def is_cjk(s: Column) -> Column:
    return s.rlike(CJK_PATTERN)


def term_text(title: Column, summary: Column, tags: Column) -> Column:
    """The text terms are taken from."""
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")), F.array_join(tags, " "))


def exploded_terms(
    rows: DataFrame, keep: list[str], s: Column, stop_en: list[str] = STOPWORDS_EN, stop_zh: list[str] = STOPWORDS_ZH,
) -> DataFrame:
    """One row per term: words of three letters or more in lower case and CJK runs of two or more,
    without stop words. Case and stop words are dealt with per exploded row, in generated code."""
    found = rows.select(*keep, F.explode(F.regexp_extract_all(s, F.lit(TOKEN_PATTERN), F.lit(0))).alias("term"))
    lowered = found.withColumn("term", F.lower("term"))  # a token is ASCII letters and hyphens, or CJK
    long_enough = (F.length("term") >= 3) | is_cjk(F.col("term"))
    return lowered.filter(long_enough & ~F.col("term").isin(*stop_en, *stop_zh))


def token_cost(s: Column) -> Column:
    """Rough size of a text in model tokens."""
    return F.greatest(F.lit(1), F.floor(F.length(s) / 3)).cast("long")


def embedded_json(text: Column, schema: T.StructType | str, fallback: Column) -> Column:
    """The object from the first '{' to the last '}', or ``fallback`` when it does not parse."""
    body = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    # the parser stops after the first value, so text behind it only shows inside a closed frame
    framed = F.try_parse_json(F.concat(F.lit('{"x":['), body, F.lit("]}")))
    single = framed.isNotNull() & F.try_variant_get(framed, "$.x[1]", "variant").isNull()
    return F.when(single, F.from_json(body, schema)).otherwise(fallback)


def mention(n: Column, where: Column, titles: Column) -> Column:
    """Why a host is suggested: count, host and its first two titles."""
    return F.concat(
        n.cast("string"), F.lit(REASON_FROM), where, F.lit(REASON_SAMPLE),
        F.array_join(F.slice(titles, 1, 2), REASON_JOIN),
    )


class _Text(html.parser.HTMLParser):
    """Collects text nodes; script, style, template and ruby annotations are not text."""

    SILENT = {"script", "style", "template", "rt", "rp"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.pending: list[str] = []
        self.silent = 0

    def flush(self) -> None:
        piece = "".join(self.pending).strip()
        self.pending.clear()
        if piece and not self.silent:
            self.pieces.append(piece)

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.silent += tag in self.SILENT

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.SILENT and self.silent:
            self.silent -= 1

    def handle_comment(self, data):
        self.flush()

    def handle_data(self, data):
        self.pending.append(data)


def _plain(markup: str | None) -> str:
    if not markup:
        return ""
    parser = _Text()
    parser.feed(markup)
    parser.close()
    parser.flush()
    return " ".join(parser.pieces)


@F.pandas_udf(T.StringType())
def html_text(markup: pd.Series) -> pd.Series:
    """Text of an HTML fragment or page, pieces joined with a blank."""
    return markup.map(_plain)


def html_title(markup: Column) -> Column:
    return squeeze(F.regexp_extract(markup, r"(?is)<title[^>]*>(.*?)</title>", 1))
