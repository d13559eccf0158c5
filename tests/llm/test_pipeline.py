"""The pipeline's stages against brute force on the smallest tables."""
import random
import re

import pytest

import corpus_pipeline
from pressmill.llm import langid
from pressmill.llm.simhash import fingerprint

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(None, "12 34", None, None, None), (5, None, "en", "s", 3), (7, "...", None, None, 0)], docs.schema)
    again = docs.orderBy("doc_id").limit(3)
    docs = docs.unionByName(extra).unionByName(again)
    docs.write.parquet(str(root / "start"))
    results = [spark.read.parquet(str(root / "start"))]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, results[-1], SMALL).write.parquet(str(root / str(number)))
        results.append(spark.read.parquet(str(root / str(number))))
    return results


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_order_and_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "packing"]
    assert all(df.columns == outputs[0].columns for df in outputs[1:5])
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_drops_only_texts_of_no_language(outputs):
    kept = rows_of(outputs[1])
    assert kept == [r for r in rows_of(outputs[0]) if r[1] and re.search(r"[^\W\d_]", r[1])]


def test_lines_drop_what_ten_documents_share(outputs):
    before = rows_of(outputs[1])
    keys = [[re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r")) for x in r[1].split("\n")] for r in before]
    count = {}
    for row in keys:
        for k in set(row) - {""}:
            count[k] = count.get(k, 0) + 1
    want = []
    for r, row in zip(before, keys):
        text = "\n".join(x for x, k in zip(r[1].split("\n"), row) if count.get(k, 0) < 10)
        want.append((r[0], text, r[2], r[3], len(text)))
    assert rows_of(outputs[2]) == sorted(want, key=str)


def test_one_document_of_each_group_of_copies_stays(outputs):
    before = rows_of(outputs[2])
    sets = [shingles(r[1]) for r in before]
    prints = [int.from_bytes(fingerprint(r[1].encode()), "big") for r in before]
    root = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= 3
            if near or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    groups = {}
    for r, g in zip(before, root):
        groups.setdefault(g, []).append(r)
    assert len(groups) < len(before)
    assert sorted(r[0] for r in rows_of(outputs[3])) == sorted(min(x[0] for x in g) for g in groups.values())


def test_documents_with_benchmark_passages_go(spark, outputs):
    phrases = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        phrases |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    sizes = {len(p) for p in phrases}

    def clean(text):
        w = words(text)
        return not any(tuple(w[i:i + n]) in phrases for n in sizes for i in range(len(w) - n + 1))

    before = rows_of(outputs[3])
    want = [r for r in before if clean(r[1])]
    assert rows_of(outputs[4]) == want and len(want) < len(before)


def test_packing_holds_every_word_once(outputs):
    docs = {r.doc_id: r for r in outputs[4].collect()}
    packed = outputs[5].collect()
    got, bins = {}, {}
    for r in packed:
        got.setdefault(r.doc_id, []).append((r.first_word, r.n_words))
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert set(got) == set(docs)
    for key, pieces in got.items():
        assert sum(n for _, n in pieces) == len(docs[key].text.split())
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 2048 and len({docs[r.doc_id].source for r in held}) == len(held)


def test_stages_on_no_rows(spark, outputs):
    none = outputs[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_threshold_keeps_mixtures_of_two():
    assert corpus_pipeline.LEAST_SHARE < 0.5 and langid.UNKNOWN == "und"


def test_language_rejects_gibberish_and_mixtures_of_many(spark, tmp_path):
    rng = random.Random(2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.where("lang is not null and n_chars > 200").orderBy("doc_id").collect()
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r.text)
    langs = sorted(by_lang)
    assert len(langs) == 4
    planted = [("".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)), False) for n in (200, 1000, 5000)]
    planted.append((" ".join(" ".join(by_lang[x])[:3000] for x in langs), False))
    planted.append((" ".join(" ".join(by_lang[x])[:3000] for x in langs[:2]), True))
    planted += [(by_lang[x][0], True) for x in langs]
    extra = spark.createDataFrame([(-1 - k, t, None, "planted", len(t)) for k, (t, _) in enumerate(planted)], docs.schema)
    docs.unionByName(extra).write.parquet(str(tmp_path / "docs"))
    kept = corpus_pipeline.language(spark, spark.read.parquet(str(tmp_path / "docs")), SMALL)
    found = {r.doc_id for r in kept.collect()}
    assert [-1 - k in found for k in range(len(planted))] == [good for _, good in planted]
    assert {r.doc_id for r in rows} <= found


ODD = ["my-col", "n_lines", "n_dropped", "pipeline_row", "text_key", "lines_before", "doc", "a.b c`d", "key", "row"]


def odd_docs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(*r, *[f"{c}-{k}" for c in ODD]) for k, r in enumerate(docs.orderBy("doc_id").collect())]
    schema = docs.schema
    for name in ODD:
        schema = schema.add(name, "string")
    return spark.createDataFrame(rows, schema)


def test_stages_keep_columns_of_any_name(spark, outputs, tmp_path):
    now = odd_docs(spark)
    want = {r.doc_id: tuple(r[c] for c in ODD) for r in now.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        now.write.parquet(str(tmp_path / str(number)))
        given = spark.read.parquet(str(tmp_path / str(number)))
        now = stage(spark, given, SMALL)
        assert now.columns == given.columns
        got = now.collect()
        assert got and all(tuple(r[c] for c in ODD) == want[r.doc_id] for r in got)
    assert corpus_pipeline.packing(spark, spark.read.parquet(str(tmp_path / "3")), SMALL).count() > 0


def test_runs_beside_each_other_stay_readable(spark, outputs, tmp_path):
    """Neither a later run nor the stages of another table delete what a result reads."""
    first = corpus_pipeline.run(spark, SMALL)
    n = first.count()
    a = corpus_pipeline.near_duplicates(spark, outputs[2], SMALL)
    b = corpus_pipeline.decontamination(spark, outputs[3], SMALL)
    c = corpus_pipeline.lines(spark, outputs[1], SMALL)
    second = corpus_pipeline.run(spark, SMALL)
    assert (a.count(), b.count(), c.count()) == (outputs[3].count(), outputs[4].count(), outputs[2].count())
    assert first.count() == second.count() == n
    key = ["doc_id", "piece", "n_words"]
    assert sorted(map(tuple, first.select(*key).collect()), key=str) == sorted(map(tuple, second.select(*key).collect()), key=str)


def test_stages_on_texts_of_any_length(spark, outputs):
    rows = outputs[0].where("n_chars > 500").orderBy("doc_id").collect()
    whole = " ".join(r.text for r in rows)
    docs = spark.createDataFrame([(1, whole, "en", "s", None), (2, "", None, None, None), (3, None, None, None, 1), (4, rows[0].text, None, "s", 2)], outputs[0].schema)
    kept = {name: {r.doc_id for r in stage(spark, docs, SMALL).collect()} for name, stage in corpus_pipeline.STAGES}
    assert kept["language"] <= {1, 4} and 4 in kept["language"]
    assert kept["lines"] == kept["packing"] == {1, 2, 3, 4}
    assert kept["near_duplicates"] == {1, 2, 4}  # null counts as empty
    assert kept["decontamination"] >= {2, 3} and 1 not in kept["decontamination"]  # all passages are in the whole
