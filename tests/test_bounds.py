"""What is sent, met and read stays in proportion to the rows."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.functions.titles import gram_counts, indel
from pressmill.operators import posting, title_join, vector_join


def test_grams_bound_the_distance():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (" ".join(sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(6)})) for _ in "ab")
        only_a, only_b = (sorted(set(x.split()) - set(y.split())) for x, y in ((a, b), (b, a)))
        if only_a and only_b:
            d = indel(" ".join(only_a), " ".join(only_b))
            pairs, triples = (counts.astype(int) for counts in gram_counts([a, b], 256, 512))
            assert abs(pairs[0] - pairs[1]).sum() <= 3 * d and abs(triples[0] - triples[1]).sum() <= 5 * d


def test_titles_that_share_their_key_are_no_candidates(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    rows = [(i, sorted({"internationalisation", *rng.sample(vocabulary, 8)})) for i in range(200)]
    rows += [(1000 + i, rows[i][1][:-1]) for i in range(5) if rows[i][1][-1] != "internationalisation"]
    titles = title_join.prepared(spark.createDataFrame(rows, "arrival long, tokens array<string>"), 100.0)
    met = {tuple(r) for r in title_join._contained(titles.rows, titles.rows, True, titles, 10**6).collect()}
    within = {(p, i) for p, w in rows for i, v in rows if i < p and (set(w) <= set(v) or set(v) <= set(w))}
    assert within <= met and len(met) <= len(within) + 20


def test_many_stripes_of_titles(spark, monkeypatch):
    monkeypatch.setattr(title_join, "STRIPE", 1)
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdefghijklmno ") for _ in range(30)) for _ in range(12)]
    texts = [(s[:k] + rng.choice("xyz") + s[k + 1:]) for s in stems for k in rng.sample(range(30), 6)]
    df = spark.createDataFrame(list(enumerate(texts)), "arrival long, title string")
    many = title_join.keep_first_titles(df, 85.0, block=5).collect()
    monkeypatch.setattr(title_join, "STRIPE", 10_000)
    assert sorted(many) == sorted(title_join.keep_first_titles(df, 85.0, block=512).collect())


def test_vectors_are_sent_once_per_stripe():
    packs = vector_join._packed({c: 10 for c in range(40)}, 40, 100)
    assert packs.max() == 3
    refs = np.random.default_rng(1).normal(size=(40, 8))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    import pandas as pd
    probe = pd.DataFrame({"arrival": range(40), "dim": 8, "unit": list(refs)})
    sent, = vector_join._packs([probe], refs, 3.0, packs)
    assert [list(p) for p in sent["packs"]] == [[0, 1, 2, 3]] * 40


@pytest.mark.parametrize("threshold", [0.2, 0.8])
def test_vectors_in_many_stripes(spark, threshold):
    units = np.random.default_rng(2).normal(size=(150, 5))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, 5, u.tolist()) for i, u in enumerate(units)], "arrival long, dim int, unit array<double>")
    got = {tuple(r) for r in vector_join.nearest_vectors(rows, rows, True, threshold, units[:20], block=4, stripe=30).collect()}
    hits = [(i, [k for k in range(i) if units[k] @ units[i] >= threshold]) for i in range(150)]
    assert got == {(i, h[0]) for i, h in hits if h}


def test_many_hits_are_read_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(posting, "FIRST_READ", 2)
    monkeypatch.setattr(posting, "MOST_READ", 4)
    rows = [(dt.date(2026, 1, 1 + i % 3), f"a common title {i}", f"h{i:02}") for i in range(60)]
    items = spark.createDataFrame(rows, "date date, title string, url_hash string").withColumns({
        "summary": F.lit(""), "insight": F.lit(""), "tags": F.array().cast("array<string>"), "section_label": F.lit("")})
    posting.write_postings(items, str(tmp_path / "index"))
    found = posting.search_postings(spark, str(tmp_path / "index"), "common", limit=1000)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert sorted(r["url_hash"] for r in found.collect()) == sorted(r[2] for r in rows)
    few = posting.search_postings(spark, str(tmp_path / "index"), "common", limit=3).collect()
    assert [r["url_hash"] for r in few] == ["h02", "h05", "h08"]
