"""Sketches against whole shingle sets, edited fingerprints against a plain loop."""
import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmill.llm import queries, sketch

SMALL = "/root/testdata/sf0.001"


def shingles(text, size=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def made(*texts):
    return sketch.sketch_texts(pa.array([t.encode() for t in texts], pa.large_binary()))


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


def test_sketch_keeps_an_eighth_and_estimates_containment():
    rng = random.Random(1)
    book, note = prose(rng, 40000), prose(rng, 4000)
    words = book.split()
    part = " ".join(words[8000:12000])
    mixed = " ".join([*words[100:1100], *note.split()[:3000]])
    a, b, c, d = made(book, part, note, mixed)
    assert abs(len(a.hashes) / 40000 - 1 / 8) < 0.01
    assert sketch.likeness(a, b) == 1.0 and sketch.likeness(a, c) == 0.0
    assert abs(sketch.likeness(a, d) - len(shingles(book) & shingles(mixed)) / len(shingles(mixed))) < 0.05
    assert a.text() == made(book.upper())[0].text() != b.text()
    assert set(made(book + " " + part)[0].hashes) >= set(a.hashes)


def test_sketch_does_not_depend_on_the_batch():
    rng = random.Random(2)
    texts = ["", " . ", "one", "One two", "a b c d e", prose(rng, 300), "x" * 90000, prose(rng, 200000), "é ü — “ß” 漢字 a b c d"]
    together = [s.text() for s in made(*texts)]
    assert together == [made(t)[0].text() for t in texts]
    assert together[0] == together[1] == "0:" and together[2].startswith("1:")


def test_likeness_of_short_texts():
    texts = [f"w{i} v{i}" for i in range(60)]
    found = made(*texts, "", "...")
    assert any(not len(s.hashes) for s in found[:60]) and any(len(s.hashes) for s in found[:60])
    for i in range(60):
        for j in range(60):
            assert sketch.likeness(found[i], found[j]) == float(i == j)
    assert sketch.likeness(found[60], found[61]) == 1.0 and sketch.likeness(found[0], found[60]) == 0.0


def test_sketches_merge(spark):
    rng = random.Random(3)
    texts = [prose(rng, 400) for _ in range(6)]
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)] + [(6, None, 0)], "`my-id` long, text string, hashes int")
    found = sketch.sketches(docs, "my-id")
    got = {r["my-id"]: r for r in found.collect()}
    assert got[6].hashes == [] and got[6].n_shingles == 0 and got[0].n_shingles == 396
    union = sketch.merged(found, F.col("my-id") % 2).groupBy("key").agg(F.collect_set("hash").alias("h"))
    for r in union.collect():
        assert set(r.h) == {h for i in range(7) if i % 2 == r.key for h in got[i].hashes}
    one = found.where("`my-id` = 0").select(F.col("hashes").alias("a")).crossJoin(union.where("key = 0").select("h"))
    assert one.select(sketch.contained(F.col("a"), F.col("h"))).first()[0] == 1.0
    assert sketch.sketches(docs.limit(0), "my-id").count() == 0


def plain(rows):
    """(id, n, sha256 of the edited text, edited text, text, next text) in the stated order, ties in any."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), edited, text, after))
    return out


def compare(got, rows):
    want = plain(rows)
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == sorted([w[:3] for w in want], key=str)
    by = {r.doc_id: r for r in got}
    for i, _, _, edited, text, after in want:
        a, b, c = made(text, edited, after)
        r = by[i]
        assert (r.fingerprint, r.edited_fingerprint) == (a.text(), b.text())
        assert (r.near_edited, r.near_next) == (sketch.likeness(a, b), sketch.likeness(a, c))
        assert r.edited_chars == len(edited)


@pytest.mark.parametrize("parts", [1, 4])
def test_edited_fingerprints_equal_a_plain_loop(spark, parts):
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(120)) for _ in range(90)] + [None, "", "é漢" * 31, "x" * 70001, "the\n\nend", "same text here", "same text here"]
    rows = [(rng.randrange(-10**6, 10**6) * 1000 + k, t) for k, t in enumerate(texts)] + [(-2**63, "least"), (2**63 - 1, "most"), (None, "no id " * 40)]
    frame = spark.createDataFrame([(t, i, 5, "g") for i, t in rows], "text string, doc_id long, bucket int, guest string").repartition(parts)
    compare(sketch.edited_fingerprints(frame).collect(), rows)


def test_edited_fingerprints_of_few_and_repeated_rows(spark):
    def run(rows):
        return sketch.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()

    assert run([]) == []
    alone = run([(5, "a b c d e f")])
    assert len(alone) == 1 and alone[0].near_next == 1.0 and alone[0].edited_chars == 11
    compare(run([(1, "p q r s t u v"), (2, None)]), [(1, "p q r s t u v"), (2, None)])
    again = run([(3, "abcdefgh")] * 40 + [(2, "12345678")])
    assert sorted((r.doc_id, r.near_next) for r in again if r.near_next < 1) == [(2, 0.0), (3, 0.0)] and len(again) == 41
    ties = run([(7, f"{k} text " * 9) for k in range(50)] + [(None, f"{k} null") for k in range(50)])
    assert len(ties) == 100 and len({r.edited_sha256 for r in ties}) == 100


def test_query_on_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.op12_fingerprints(spark, SMALL).collect()
    compare(got, rows)
    halves = [r.near_edited for r in got if r.n_chars > 2000 and r.near_next < 0.1]
    assert 0.4 < sum(halves) / len(halves) < 0.65
