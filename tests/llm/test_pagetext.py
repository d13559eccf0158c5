"""Main text of pages: cases, and a slow version on random pages."""
import math
import random

import numpy as np
import pytest

from pressmill.llm import pagetext
from pressmill.llm.pagetext import main_text

LONG = "A sentence of the article that goes on for quite a while, as sentences of articles do, and then some more. " * 2
P1, P2, P3 = (f"{k} {LONG.strip()}" for k in ("First:", "Second:", "Third:"))
NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
FOOT = "<footer>&copy; 2026 Example</footer>"


def page(body, head="<head><title>T</title></head>"):
    return f"<html>{head}<body>{NAV}{body}{FOOT}</body></html>"


@pytest.mark.parametrize("html,want", [
    # a head without an end tag
    (f"<html><head><title>T</title><meta charset=utf-8><body>{NAV}<article><p>{P1}</p></article>{FOOT}", [P1]),
    (f"<head><title>T</title><style>p{{}}</style><article><p>{P1}<p>{P2}</article>", [P1, P2]),
    # silent elements that are not closed end with what they stand in
    (page(f"<article><div><button>Click</div><p>{P1}</p><p>{P2}</p></article>"), [P1, P2]),
    (page(f"<article><p>{P1} <button>Buy</p><p>{P2}</p></article>"), [P1, P2]),
    (page(f"<article><section><svg><path></section><p>{P1}</p></article>"), [P1]),
    # a body in two sibling containers, and one beside
    (page(f"<div><p>{P1}</p><p>{P2}</p><p>{P3}</p></div><div><p>{P3}</p></div>"), [P1, P2, P3, P3]),
    (page(f"<div id=x><div><p>{P1}</p><p>{P2}</p></div><div><ul><li>one</li><li>two</li></ul></div><div><p>{P3}</p></div></div>"),
     [P1, P2, "one", "two", P3]),
    # two articles
    (page(f"<article><p>{P1}</p><p>{P2}</p></article><article><h2>Short</h2><p>{P3}</p></article>"), [P1, P2, "Short", P3]),
    # names that are not furniture, and some that are
    (page(f'<article><div class="article-header"><h1>Head</h1></div><section id="social-science"><p>{P1}</p></section></article>'), ["Head", P1]),
    (page(f'<article><p class="advert">Buy now</p><p>{P1} <span class="ad">cheap</span>end</p><p class="site-notice">note<p>{P2}</article>'),
     [P1, f"{P1} end", P2][1:]),
    (page(f'<article><p>{P1}</p><div class="comment-list"><p>{P2}</p></div><ul><li class=ad>x<li>kept</ul></article>'), [P1, "kept"]),
    (page(f'<div class="post"><h1>Head</h1><p>{P1}</p></div><div class="cookie-banner"><p>{P2}</p></div>'), ["Head", P1]),
    (page(f'<article><p hidden>{P2}</p><p aria-hidden=true>{P3}</p><p>{P1}</p></article>'), [P1]),
    # comments as articles
    (page(f'<article><p>{P1}</p><p>{P2}</p></article><article class="comment"><p>{P3}</p></article>'), [P1, P2]),
    # tables, lists, figures, references, white space
    (page(f"<article><p>a&amp;b &lt;c&gt;\n  {P1}<br>x</p><table><tr><td>1<td>2</table><figure><figcaption>cap</figcaption></figure></article>"),
     [f"a&b <c> {P1} x", "1", "2", "cap"]),
    ("", []), ("<p></p>", []), ("plain", ["plain"]), ("</div></p>text", ["text"]), ("<nav>only</nav>", []), ("<p>a", ["a"]),
])
def test_cases(html, want):
    assert main_text(html) == want


def test_ratios_choose_where_nothing_is_named():
    links = "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(12))
    html = (f"<html><body><div><ul>{links}</ul></div><div><h1>Head</h1><p>{P1}</p><p>{P2}</p><ul><li>x</li></ul><p>{P3}</p></div>"
            f"<div><a href=/1>One</a> <a href=/2>Two</a></div><div><ul>{links}</ul></div></body></html>")
    assert main_text(html) == ["Head", P1, P2, "x", P3]


def test_random_ratios_change_the_text(monkeypatch):
    links = "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(12))
    html = f"<body><div><ul>{links}</ul></div><div><p>{P1}</p><p>{P2}</p></div><div><ul>{links}</ul></div></body>"
    want = main_text(html)
    assert want == [P1, P2]
    rng = np.random.default_rng(1)
    monkeypatch.setattr(pagetext, "smoothed", lambda ratio, *_: rng.random(len(ratio)))
    assert sum(main_text(html) != want for _ in range(20)) > 15


def test_very_long_page():
    blocks = [f"{k} {LONG.strip()}" for k in range(3000)]
    assert main_text(page("<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>")) == blocks
    assert main_text(page("<div>" * 300 + f"<p>{P1}</p>" + "</div>" * 300)) == [P1]


def made_tree(rng, depth=0):
    """A random page as (tag, class, children): strings are text."""
    tag = rng.choice(["div", "section", "ul", "p", "p", "p", "article", "nav", "aside"]) if depth else "body"
    name = rng.choice(["", "", "", "ad", "post", "comment-list", "article-header"]) if depth else ""
    if tag == "p":
        return tag, name, [rng.choice(["x", "some words", LONG, LONG]) + str(rng.randrange(1000))]
    if tag == "ul":
        return tag, name, [("li", "", [f"item {rng.randrange(100)}"]) for _ in range(rng.randint(1, 4))]
    return tag, name, [made_tree(rng, depth + 1) for _ in range(rng.randint(1, 5 if depth < 3 else 2))] if depth < 5 else []


def as_html(node):
    if isinstance(node, str):
        return node
    tag, name, children = node
    return f"<{tag}{f' class={name}' if name else ''}>" + "".join(map(as_html, children)) + f"</{tag}>"


BLOCKS = {"body", "div", "section", "ul", "p", "article", "nav", "aside", "li"}


def slow(tree):
    """The definition, node by node: lines, ratios, Gaussian, threshold, regions."""
    lines, tags, waiting = [], 1, []  # the html tag

    def tag_met():
        """A block's tag ends a line, and counts for the line before it."""
        nonlocal tags
        tags += 1
        if waiting:
            text, path, gone = waiting.pop()
            lines.append((text, tags, path, gone))
            tags = 0

    def walk(node, path, gone):
        tag, name, children = node
        tag_met()
        gone = gone or tag in ("nav", "aside") or name in ("ad", "comment-list")
        path = [*path, node]
        for child in children:
            if isinstance(child, str):
                waiting.append((" ".join(child.split()), path, gone))
            else:
                walk(child, path, gone)
        tag_met()

    walk(tree, [], False)
    good = [x for x in lines if not x[3]]
    if not good:
        return []
    ratio = [len(t) / max(1, k) for t, k, _, _ in good]
    smooth = []
    for i in range(len(ratio)):
        weights = [(math.exp(-0.5 * ((i - j) / pagetext.SIGMA) ** 2), r) for j, r in enumerate(ratio) if abs(i - j) <= math.ceil(3 * pagetext.SIGMA)]
        smooth.append(sum(w * r for w, r in weights) / sum(w for w, _ in weights))
    mean = sum(smooth) / len(smooth)
    bar = pagetext.THRESHOLD * math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    content = [s >= bar and r >= bar for s, r in zip(smooth, ratio)]

    def home(path):
        for k, node in enumerate(path):
            if node[0] == "article":
                return path[:k + 1]
        return path[:max(k for k, node in enumerate(path) if node[0] in ("body", "div", "section")) + 1]

    homes = [home(path) for _, _, path, _ in good]
    named = [h[-1][0] == "article" for h in homes]
    mass = [len(t) * c for (t, *_), c in zip(good, content)]
    if sum(m for m, n in zip(mass, named) if n) >= pagetext.ARTICLE_SHARE * sum(mass):
        content = [c and n for c, n in zip(content, named)]
    if not any(content):
        return [t for t, *_ in good]
    branch = [h[-1] if n else h[1] if len(h) > 1 else None for h, n in zip(homes, named)]
    region = []
    for b, h, c in zip(branch, homes, content):
        if b is None or not c:
            continue
        for entry in region:
            if entry[0] is b:
                entry[1] = [x for x, y in zip(entry[1], h) if x is y]
                break
        else:
            region.append([b, h])
    at = [k for k, c in enumerate(content) if c]
    out = []
    for k, (text, _, path, _) in enumerate(good):
        mine = next((r for b, r in region if b is branch[k]), None)
        if mine is not None:
            if any(x is mine[-1] for x in path):
                out.append(text)
        elif at[0] <= k <= at[-1] and (content[k] or not any(named)):
            out.append(text)
    return out


def test_equal_to_a_slow_version():
    rng = random.Random(6)
    partly = 0
    for _ in range(600):
        tree = made_tree(rng)
        got, want = main_text("<html>" + as_html(tree) + "</html>"), slow(tree)
        assert got == want
        partly += 0 < len(got) < 6
    assert partly > 100


def test_columns_of_any_name(spark):
    pages = spark.createDataFrame([(1, f"<p>{P1}</p>", "u", 5), (None, None, None, None)], "`page-id` long, `html x` string, url string, page int")
    got = pagetext.extract(pages, "html x", ("page-id", "url", "page")).collect()
    assert [(r["page-id"], r.url, r.page, r.text, r.n_chars) for r in got] == [(1, "u", 5, P1, len(P1)), (None, None, None, "", 0)]
