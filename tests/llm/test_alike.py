import random

import numpy as np
import pytest

from pressmill.llm import alike
from pressmill.llm import words as W
from pressmill.llm.components import components


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_parts_and_levels():
    rng = np.random.default_rng(1)
    for n in (1, 2, 4, 7, 8, 40, 200, 3000):
        own = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for level in alike.levels(len(own), 0.8):
            got = alike.parts(own, level)
            assert 1 <= len(got) <= alike.PARTS and (got == alike.parts(own[::-1].copy(), level)).all()
    for n in range(1, 500):
        assert all(set(alike.levels(n, 0.8)) & set(alike.levels(m, 0.8)) for m in range(n, int(n / 0.8) + 1))


@pytest.mark.parametrize("group", [256, 20])
def test_links_find_similar_texts_and_no_others(spark, group):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(3000)}" for _ in range(n)] for n in (40, 60, 120, 250, 800, 4000)]
    texts = [" ".join(b) for b in base]
    for b in base:
        texts += [" ".join(edited(b, max(1, len(b) // 120), rng)) for _ in range(6)]
        texts += [" ".join(edited(b, len(b) // 8, rng)), " ".join(b[: len(b) // 2])]
    texts += [" ".join(edited(base[3], 1, rng)) for _ in range(60)]  # one large group
    texts += ["", "   ", "one", "ONE", "two words", " ".join(base[0]), None, "a b c d e", "a b c d f"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = {r.node: r.component for r in components(alike.similar_links(rows, "row", group=group)).collect()}
    sets = [shingle_set(t or "") for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert [found.get(i, i) for i in range(len(texts))] == root
    assert alike.similar_links(rows.limit(0), "row").count() == 0


def test_whole_sets_decide_across_sizes(spark):
    rng = random.Random(7)
    texts, linked = [], []
    for n, m in [(1020, 1030), (2047, 2048), (4095, 4096), (1000, 1200), (9000, 10000)]:  # shingles of a text and of a longer copy
        texts.append([f"w{rng.randrange(9000)}" for _ in range(m + 4)])
        texts.append(texts[-1][: n + 4])
        linked.append(True)
    for keep in [2390, 2410] * 8:  # of 3,000: 0.797 and 0.803
        texts.append([f"w{rng.randrange(10**6)}" for _ in range(3004)])
        texts.append(texts[-1][: keep + 4])
        linked.append(keep == 2410)
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "row long, text string").repartition(3)
    edges = {tuple(sorted((r.a, r.b))) for r in alike.similar_links(rows, "row").collect()}
    assert edges == {(2 * k, 2 * k + 1) for k, good in enumerate(linked) if good}
