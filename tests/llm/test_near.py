import random
import re

import pytest
from pyspark.sql import functions as F

from pressmill.llm import simhash
from pressmill.llm.components import components


def brute(prints, radius):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    for level in range(3):
        masks = simhash.covering_masks(3, level)
        assert len(masks) == 15
        for _ in range(3000):
            x = sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3)))
            assert any(not x & m for m in masks)


def test_fingerprint_counts_repeats_and_handles_short_texts():
    import xxhash

    def slow(text):
        words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
        if not words:
            return 0
        parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if len(words) >= 3 else [" ".join(words)]
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in ["", " \t ", "one", "one two", "a b c", "a b c a b c a b c", "x " * 5000, "The THE the\n\n end  of é É"]:
        assert int.from_bytes(simhash.fingerprint(text.encode()), "big") == slow(text)


@pytest.mark.parametrize("bucket", [1024, 3])
def test_links_join_the_same_sets_as_all_pairs(spark, bucket):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for base in list(prints[:15]):
        for _ in range(12):
            prints.append(prints[-1] ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))))
            prints.append(base ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4))))
    prints = sorted({simhash._signed(p) for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r.node: r.component for r in components(simhash.links(df, bucket=bucket)).collect()}
    want = brute([p & (2**64 - 1) for p in prints], 3)
    for p, w in zip(prints, want):
        assert got.get(p, p) == prints[w]


def test_near_groups_on_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(7, text, "a"), (3, text, None), (3, text, "a"), (9, text + " more", None), (1, None, None), (2, "  ", None), (None, "", "x"),
            (None, "only null here now", None), (4, "long " * 40000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    found = simhash.near_groups(docs).collect()
    got = sorted(((-1 if r[0] is None else r[0]), (-1 if r[2] is None else r[2])) for r in found)
    fp = {r[1]: int.from_bytes(simhash.fingerprint((r[1] or "").encode()), "big") for r in rows}
    assert (fp[text] ^ fp[text + " more"]).bit_count() <= 3
    assert got[:2] == [(-1, -1), (-1, 1)]
    assert got[2:] == [(1, 1), (2, 1), (3, 3), (3, 3), (4, 4), (7, 3), (9, 3)]
    assert simhash.near_groups(docs.where(F.lit(False))).count() == 0


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1002, 1001), (5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect()}
    assert set(got) == {*range(301), 1000, 1001, 1002}
    assert all(v == (0 if k < 1000 else 1000) for k, v in got.items())
