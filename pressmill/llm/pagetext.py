"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events of a page; block-level tags cut its text into lines. The ratio of a line is
its characters over its tags. Ratios are smoothed by a Gaussian over neighbouring lines; lines above the threshold, a share
of the deviation, by themselves and with their neighbours, form clusters of content. What the clusters lie in are the content regions: an article (or the main element)
as a whole, or below the body the smallest container around the clusters of each branch; so lists and short lines inside a
region stay. Lines between the first and the last cluster that are in no other branch belong to it too. All lines of the
regions that are not page furniture are the text. Furniture is told by element, role, hidden attributes and class or id names,
on any element: a name counts if it is one of the words, or made of such a word and words that say nothing else.

Defined results: null, empty or text-free html gives an empty text; a page without a cluster gives all that is no furniture; end
tags may be missing (a head ends where the body's elements begin, a silent or furniture element with what it stands in) and
tags that were never opened are ignored; repeated rows each get a row; without rows there are none; kept columns may have any
name but text and n_chars.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.words import quoted, schema

SIGMA = 1.5
THRESHOLD = 0.4
#: articles and main elements that hold this share of the content hold all of it
ARTICLE_SHARE = 0.5

BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
                   " h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
                   .split())
CONTAINERS = frozenset("article aside body details dialog div dl fieldset figure footer form header main menu nav ol section table td ul".split())
#: containers that can be a region of their own; others belong to what they stand in
REGIONS = frozenset("page body article main section div".split())
HEAD = frozenset("base link meta noscript script style template title".split())
#: elements without text of the page; those of the second kind hold no blocks, so a block ends them
SILENT = frozenset("script style head title noscript template svg canvas iframe object select textarea button math audio video".split())
PHRASES = frozenset("svg select textarea button math title".split())
FURNITURE = frozenset("nav aside footer header form menu dialog".split())
FURNITURE_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies footer"
                            " header menu nav navbar navigation newsletter notice notices popup promo related reply share sharing sidebar"
                            " social sponsor sponsored subscribe toolbar widget".split())
PLAIN_WORDS = frozenset("area bar block bottom box button buttons column container form global item items left link links list main menu page"
                        " pane panel posts primary right secondary section site slot sticky top unit wrap wrapper".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PARTS = re.compile("[-_]+")


def furniture_name(name: str) -> bool:
    """Whether a class or id name tells page furniture: "ad", "site-header", "comment_list", but not "article-header"."""
    parts = [x for x in _PARTS.split(name.lower()) if x]
    return any(x in FURNITURE_WORDS for x in parts) and all(x in FURNITURE_WORDS or x in PLAIN_WORDS for x in parts)


class Lines(HTMLParser):
    """Lines of a page: text, number of tags, containers from the outermost in, whether it is page furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], bool]] = []
        self.kinds: list[str] = ["page"]  # of all containers met, by number
        self.open: list[tuple[str, int, bool]] = [("page", 0, False)]
        self.parts: list[str] = []
        self.tags = 0
        self.silent: list[tuple[str, int]] = []  # with the number of containers open around it

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, tuple(number for _, number, _ in self.open), self.open[-1][2]))
            self.tags = 0
        self.parts.clear()

    def _marked(self, tag: str, attrs) -> bool:
        given = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        names = any(furniture_name(x) for k in ("class", "id") for x in given.get(k, "").split())
        if tag in ("html", "body", "main"):
            return False
        if tag == "article":
            return names
        in_article = any(kind in ("article", "main") for kind, _, _ in self.open)
        return (tag in FURNITURE and not (tag == "header" and in_article) or names or given.get("role") in FURNITURE_ROLES
                or "hidden" in given or given.get("aria-hidden") == "true")

    def _leave(self, k: int) -> None:
        """Closes the containers from ``k`` in, and with them what is silent inside."""
        del self.open[k:]
        while self.silent and self.silent[-1][1] > k:
            self.silent.pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if self.silent and self.silent[0][0] == "head" and tag not in HEAD and all(t != "template" for t, _ in self.silent):
            self.silent.clear()  # the body has begun
        block = tag in BLOCKS
        if block:
            while self.silent and (self.silent[-1][0] in PHRASES or self.silent[-1][0] not in SILENT):
                self.silent.pop()
            self.cut()
            last = self.open[-1][0]
            if last in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or last == tag and tag in ("li", "dt", "dd", "tr", "th", "option"):
                self._leave(len(self.open) - 1)  # a marked one whose end tag is left out
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in SILENT:
            if not (self.silent and tag == "head"):
                self.silent.append((tag, len(self.open)))
            return
        marked = self._marked(tag, attrs)
        if tag in CONTAINERS or block and marked:
            self.kinds.append(tag)
            self.open.append((tag, len(self.kinds) - 1, self.open[-1][2] or marked))
        elif marked:
            self.silent.append((tag, len(self.open)))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if any(t == tag for t, _ in self.silent):
            while self.silent.pop()[0] != tag:
                pass
        if tag in BLOCKS:
            while self.silent and (self.silent[-1][0] in PHRASES or self.silent[-1][0] not in SILENT):
                self.silent.pop()
            self.cut()
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == tag:
                    self._leave(k)
                    break
                if tag not in CONTAINERS and self.open[k][0] in CONTAINERS:
                    break  # the end of a paragraph leaves what it stands in open

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        elif tag == "br":
            self.parts.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbours, normalised at the ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = slice(reach, reach + len(ratio))
    return np.convolve(ratio, kernel)[full] / np.convolve(np.ones(len(ratio)), kernel)[full]


def _home(path: tuple[int, ...], kinds: list[str]) -> tuple[int, ...]:
    """The path to the region a line is in: an article, else main, else the nearest container that can be one."""
    for wanted in ("article", "main"):
        for k, number in enumerate(path):
            if kinds[number] == wanted:
                return path[:k + 1]
    k = len(path)
    while kinds[path[k - 1]] not in REGIONS:
        k -= 1
    return path[:k]


def main_text(html: str) -> list[str]:
    """The blocks of the main text in page order."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    kinds, lines = parser.kinds, [x for x in parser.lines if not x[3]]
    if not lines:
        return []
    length = np.array([len(text) for text, *_ in lines], float)
    own = length / np.maximum(1, [tags for _, tags, _, _ in lines])
    ratio = smoothed(own)
    bar = THRESHOLD * ratio.std()
    content = (ratio >= bar) & (own >= bar)  # a line that only its neighbours lift over the threshold makes no region
    homes = [_home(path, kinds) for _, _, path, _ in lines]
    named = np.array([kinds[home[-1]] in ("article", "main") for home in homes])
    if length[content & named].sum() >= ARTICLE_SHARE * length[content].sum():
        content &= named
    if not content.any():
        return [text for text, *_ in lines]
    roots = [sum(kinds[n] in ("page", "body") for n in home) for home in homes]
    # the branch of a line: its article or main element, else its container below the body, none for the body's own lines
    branch = [home[-1] if name else home[root] if len(home) > root else None for home, root, name in zip(homes, roots, named)]
    region: dict[int, tuple[int, ...]] = {}
    for k in np.flatnonzero(content):
        if branch[k] is not None:
            have, home = region.get(branch[k], homes[k]), homes[k]
            shared = sum(1 for _ in zip_same(have, home))
            region[branch[k]] = home[:shared]
    first, last = np.flatnonzero(content)[[0, -1]]
    out = []
    for k, (text, _, path, _) in enumerate(lines):
        inside = branch[k] in region and region[branch[k]][-1] in path
        if inside or first <= k <= last and branch[k] not in region and (content[k] or not named.any()):
            out.append(text)
    return out


def zip_same(a: tuple[int, ...], b: tuple[int, ...]) -> Iterator[int]:
    """What two paths have in common from the start."""
    for x, y in zip(a, b):
        if x != y:
            return
        yield x


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = 0
        while low < batch.num_rows:  # a few pages at a time, so that what is held stays small
            some = batch.slice(low, 256)
            texts = ["\n\n".join(main_text(x.as_py() or "")) for x in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page", "text", "n_chars"])
            low += 256


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of each page with text and n_chars."""
    read = pages.select(F.struct(*[F.col(quoted(c)) for c in keep]).alias("page"), F.col(quoted(html_col)).cast("string").alias("html"))
    found = read.mapInArrow(_extract, schema(("page", read.schema["page"].dataType), ("text", "string"), ("n_chars", "long")))
    return found.select("page.*", "text", "n_chars")
