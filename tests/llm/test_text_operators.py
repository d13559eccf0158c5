"""Operators on texts against brute force, and rows with nulls, ties, repeats, empty and long texts."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pressmill.llm import credentials, decontaminate, exact, langid, licenses, lines, packing, pagetext, pseudolikelihood, queries
from pressmill.llm import words as W

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def frame(spark, texts, parts=2):
    rows = [(i, t, None, f"s{i % 3}", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


ODD = [None, "", " ", "\n\n", "é", "One.", "x" * 70000 + " " + "word " * 30000, "The the THE", "a1b2 — c3 “quoted” ÄÖ", "The the THE"]


def test_words_and_hashes_do_not_depend_on_the_batch():
    texts = [t or "" for t in ODD]
    alone = [W.hash_texts([t], W.ALNUM)[0].tolist() for t in texts]
    assert [h.tolist() for h in W.hash_texts(texts, W.ALNUM)] == alone
    seen = {}
    for text, h in zip(texts, alone):
        assert len(h) == len(words_of(text))
        for word, x in zip(words_of(text), h):
            assert seen.setdefault(word, x) == x
    assert len(set(seen.values())) == len(seen)


def brute_hits(texts, items, size=10):
    result = []
    for text in texts:
        w, hit, names = words_of(text), set(), set()
        for name, item in items:
            v = words_of(item)
            n = min(size, len(v))
            phrases = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in phrases:
                    hit |= set(range(i, i + n))
                    names |= {name} - {None}
        result.append((len(w), sorted(hit), sorted(names)))
    return result


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 20])
def test_index_search_equals_brute_force(spark, block_words):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 80))) for _ in range(60)] + ODD
    items = [(1, "w1 w2"), (2, texts[0]), (2, texts[3]), (None, texts[4][:40]), (3, None), (4, "..."), (5, "the"), (6, texts[5] + " w1 w2")]
    docs = frame(spark, texts, 3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, list(r.hits), sorted(r.item_ids)) for r in decontaminate.contaminated_words(
        docs, bench, block_words=block_words).collect()}
    assert [got[i] for i in range(len(texts))] == brute_hits(texts, items)
    assert decontaminate.contaminated_words(docs.limit(0), bench).count() == 0
    assert not any(r.hits for r in decontaminate.contaminated_words(docs, bench.limit(0)).collect())


def test_proximity_search_allows_words_out_of_place(spark):
    texts = ["alpha beta gamma delta", "alpha x beta gamma delta", "beta alpha gamma delta", "alpha x y z beta gamma delta", "gamma"]
    index = decontaminate.build_index(frame(spark, texts, 1).orderBy("doc_id").coalesce(1))
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    found = [sorted(r.place for r in decontaminate.search(index, bench, slop=s).collect()) for s in (0, 1, 3)]
    assert found[0] == [0] and found[1] == [0, 1] and found[2] == [0, 1, 2, 3]


def brute_lines(texts, least, keep_first=False):
    keys = [[x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")] for t in texts]
    keys = [[re.sub("[A-Z]", lambda m: m[0].lower(), k) for k in row] for row in keys]
    docs = {}
    for i, row in enumerate(keys):
        for k in set(row) - {""}:
            docs.setdefault(k, []).append(i)
    bad = {k: v for k, v in docs.items() if len(v) >= least}
    kept = ["\n".join(x for x, k in zip((t or "").split("\n"), row) if k not in bad or keep_first and bad[k][0] == i)
            for i, (t, row) in enumerate(zip(texts, keys))]
    return [(len(row), (t or "").count("\n") + 1 - (new.count("\n") + 1 if new or (row and any(k not in bad for k in row)) else 0), new)
            for t, row, new in zip(texts, keys, kept)]


@pytest.mark.parametrize("max_words", [1 << 22, 512])
def test_line_dedup_equals_brute_force(spark, max_words):
    rng = random.Random(3)
    pool = [f"Line {i}" for i in range(40)] + ["", "  ", "É", "é", " Pad\t", "pad"]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(80)] + ODD
    docs = frame(spark, texts, 3).withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(docs, min_docs=5, max_words=max_words).collect()}
    want = brute_lines(texts, 5)
    for i, (n, _, text) in enumerate(want):
        assert got[i][0] == n and got[i][2] == text
        assert got[i][1] == n - (0 if not text and got[i][1] == n else text.count("\n") + 1)
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    first = lines.dedup_lines(docs.orderBy("doc_id").coalesce(1), min_docs=5, keep_first=True)
    assert {r.doc_id: r.text for r in first.collect()} == {i: x[2] for i, x in enumerate(brute_lines(texts, 5, True))}


@pytest.mark.parametrize("max_words", [1 << 22, 512])
def test_exact_groups_equal_brute_force(spark, max_words):
    texts = ODD + ["a  b", "a\tb", "a b", " a b", "A b"] * 3 + [f"text {i}" for i in range(500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "only null"), (None, "only null"), (3, texts[3]), (7, "The the THE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact.exact_groups(docs, max_words=max_words).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(re.sub("[ \t-\r]+", " ", t or "").encode()).hexdigest(), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
    for digest, ids in groups.items():
        assert [r.doc_id == r.keep_id for r in got if r.text_sha256 == digest and r.kept] == ([True] if any(i is not None for i in ids) else [None == None])
    assert exact.exact_groups(docs.limit(0)).count() == 0


def test_language_is_right_on_held_out_documents(spark):
    rows = queries.op5_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_mixture_and_odd_rows(spark):
    model = langid.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))
    import numpy as np
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (7, len(model.ratio))).astype(np.float32)
    share, fit = model.fit(counts, np.ones((7, len(model.langs)), np.float32), 200)
    assert np.allclose(share.sum(axis=1), 1, atol=1e-4)
    for row, s, f in zip(counts, share, fit):  # no other mixture is likelier
        for other in rng.dirichlet(np.ones(len(model.langs)), 30):
            assert (row * np.log(model.ratio @ other)).sum() <= f + 1e-2
    docs = frame(spark, [None, "", "12 — 34", "…", "й", "a", "the and of to in " * 9000], 2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(4)) and got[6][0] == "en" and all(got[i][0] != "und" for i in (4, 5))
    assert langid.learn(docs) is None
    assert {r.lang_pred for r in langid.classified(docs).collect()} == {"und"}
    assert langid.classified(docs.limit(0)).count() == 0


def slow_scores(network, text):
    import numpy as np
    body = (text or "").encode()
    bucket, first = pseudolikelihood.buckets(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
    around, out, bias = [w.astype(float) for w in network.weights]
    own, total = network.classes.of[bucket], 0.0
    for t in range(len(own)):
        h = np.zeros(pseudolikelihood.HIDDEN)
        for j, step in enumerate([-3, -2, -1, 1, 2, 3]):
            h += around[j, own[t + step] if 0 <= t + step < len(own) else pseudolikelihood.BOUNDARY]
        logits = out @ np.tanh(h) + bias
        total += logits[own[t]] - np.log(np.exp(logits).sum()) + network.classes.within[bucket[t]]
    return len(own), total


def test_pseudo_likelihood_equals_brute_force_and_prefers_real_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = pseudolikelihood.learn(docs)
    rng = random.Random(4)
    texts = [r.text for r in docs.where("lang = 'en' and n_chars between 300 and 3000").orderBy("doc_id").limit(40).collect()]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    got = {r.doc_id: r for r in pseudolikelihood.score(frame(spark, texts + mixed + ODD), network).collect()}
    for i, text in enumerate(texts[:8]):
        n, total = slow_scores(network, text)
        assert got[i].n_tokens == n and abs(got[i].pll - total) < 1e-3 * n and abs(got[i].score * n - total) < 1e-3 * n
    assert got[80].n_tokens == 0 and got[80].score is None and got[80].pll == 0
    assert sum(got[i].score > got[i + 40].score for i in range(40)) >= 26
    import numpy as np
    assert np.isclose(np.exp(network.classes.within[network.classes.of == 3]).sum(), 1)
    assert pseudolikelihood.score(docs.limit(0), pseudolikelihood.learn(docs.limit(0))).count() == 0


def brute_pack(pieces, capacity):
    bins, placed = [], []
    for length, source, cluster in pieces:
        fit = [(room, k) for k, (room, s, c) in enumerate(bins) if room >= length and source not in s and cluster not in c]
        if fit:
            _, k = min(fit)
        else:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] -= length
        bins[k][1] |= {source} - {None}
        bins[k][2] |= {cluster} - {None}
        placed.append(k)
    return placed


def test_best_fit_equals_brute_force():
    rng = random.Random(6)
    for capacity in (10, 100):
        pieces = sorted([(rng.randint(1, capacity), rng.choice([None, *"aaaabcdefg"]), rng.choice([None, *range(30)])) for _ in range(400)],
                        key=lambda p: -p[0])
        assert packing.best_fit(*map(list, zip(*pieces)), capacity) == brute_pack(pieces, capacity)


def test_packing_is_whole_and_without_conflicts(spark):
    rng = random.Random(7)
    texts = ["w " * rng.randint(0, 130) for _ in range(300)] + ODD
    docs = frame(spark, texts, 3).withColumn("piece", F.lit("clash"))
    rows = packing.packed_documents(docs, capacity=50, shard_pieces=64).collect()
    per_doc, bins = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for i, text in enumerate(texts):
        n = len((text or "").split())
        mine = sorted(per_doc[i], key=lambda r: r.piece)
        assert sum(r.n_words for r in mine) == n and [r.first_word for r in mine] == [50 * k for k in range(max(1, -(-n // 50)))]
        assert (mine[0].bin_id is None) == (n == 0)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 50
        assert len({r.doc_id % 3 for r in held}) == len(held)
        assert len({(texts[r.doc_id] or "").strip() for r in held}) == len(held)
    assert packing.packed_documents(docs.limit(0)).count() == 0


def brute_base(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(credentials.PATTERNS):
        pattern = {"access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}.get(kind, "(?a:" + pattern.replace("(?i)", "(?i:") + "))")
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def test_secret_spans_and_owners(spark):
    key, copied = "0123456789abcdef" * 2, "deadbeef01" * 4
    texts = [None, "", f"é token='{key}' x", f"AKIA{'ABCD1234' * 2} and token=secret:longvalue123", "api_key = short", f"PASSWORD: {copied}\npasswd={copied}",
             *[f"😀 secret=\"{copied}\"" for _ in range(8)], "token token = abcdefghijk" * 3000, "Password : aaaaaaaaaaaaaaaaaaaaaaaa1"]
    docs = frame(spark, texts).withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
    got = {r.doc_id: [(s.start, s.rank - 1, s.end, s.kind) for s in r.spans] for r in credentials.secret_spans(docs).collect()}
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[3] in ("assign", "access", "hex")] == brute_base(text)
    start = texts[2].index(key)
    assert (start, 4, start + 32, "live") in got[2]
    assert {s[3] for s in got[5] if s[1] > 2} == {"example"} and {s[3] for s in got[7] if s[1] > 2} == {"example"}
    assert credentials.secret_spans(docs.limit(0)).count() == 0


def test_license_phrases_and_templates(spark):
    mit = licenses.TEMPLATES[5][1]
    texts = [None, "", "Released under the MIT License.", "mit-license apache license MIT  License, cc by cc by", f"intro words {mit} end",
             "x " * 40000 + mit.replace("free of charge", "entirely free of any charge") + " tail", mit[:80], "This is the license", "gnu general public"]
    got = {r.doc_id: r for r in licenses.license_labels(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        w = words_of(text)
        places = sorted((j, label) for phrase, label in licenses.PHRASES for j in range(len(w))
                        if w[j:j + len(phrase.split())] == phrase.split())
        assert (got[i].n_words, got[i].n_base) == (len(w), len(places))
        assert (got[i].first_word, got[i].last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert sorted(got[i].base_labels) == sorted({x for _, x in places})
    labels = {i: [(s.label, s.first_word) for s in r.spans] for i, r in got.items()}
    assert labels[2] == [("mit", 0)] and labels[4] == [("mit", 2)] and labels[5] == [("mit", 40000)]
    assert not labels[0] and not labels[6] and not labels[7] and not labels[8]
    assert licenses.license_labels(frame(spark, texts).limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div>%s<div class="comments"><p>Nice post, thank you for all these many words.</p></div>
<form><label>Mail</label><input></form><footer>&copy; x</footer></body></html>"""
ARTICLE = "<h1>A &amp; B</h1><p><b>First   line\nof text.<br><p>Short.</p><p>Caf&eacute; &#x41; <i>in</i>line</p><aside>More</aside>"


def test_main_text():
    want = ["A & B", "First line of text.", "Short.", "Café A inline"]
    assert pagetext.main_text(PAGE % f"<article>{ARTICLE}</article>") == want
    assert pagetext.main_text(PAGE % f"<article>{ARTICLE}") == want
    assert pagetext.main_text(PAGE % f"<div class=story>{ARTICLE}</div>") == want
    assert pagetext.main_text("") == [] == pagetext.main_text("<script>x</script>") == pagetext.main_text("<nav>a</nav>")
    assert pagetext.main_text("plain &lt;words") == ["plain <words"]
    assert len(pagetext.main_text("<article>" + "<p>again" * 5000)) == 5000


def test_extract_on_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "v", "<p>x</p>"), (None, "v", "<p>x</p>")], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in pagetext.extract(pages).collect())
    assert got == [(0, "v", "x", 1), (0, "v", "x", 1), (1, "u", "", 0), (2, "", "", 0)]
    assert pagetext.extract(pages.limit(0)).count() == 0


def test_many_languages_keep_their_evidence(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    shared = rng.choice(langid.FEATURES, 3000, replace=False)
    chance = rng.dirichlet(np.ones(3000)) * np.exp(rng.normal(0, 0.4, (20, 3000)))  # sisters differ in frequencies only
    chance /= chance.sum(axis=1, keepdims=True)
    counts = np.zeros((20, langid.FEATURES))
    counts[:, shared] = [rng.multinomial(200_000, p) for p in chance]
    model = langid.Model([f"l{k:02}" for k in range(20)], counts)
    table = np.zeros((60, langid.FEATURES), np.float32)
    table[:, shared] = [rng.multinomial(600, chance[k % 20]) for k in range(60)]
    assert (model.predict(table)[0] == np.arange(60) % 20).all()
    mixed = np.zeros((1, langid.FEATURES), np.float32)
    mixed[0, shared] = sum(rng.multinomial(6000, chance[k]) for k in range(5))
    assert model.predict(mixed)[1][0] < 0.3  # more than three languages in one text
    docs = spark.createDataFrame([(f"l{k}", f"word{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(300)], "lang string, text string")
    assert len(langid.learn(docs).langs) == 300


def test_pseudo_likelihood_trains_on_every_word(spark, monkeypatch):
    import numpy as np
    class Held:
        value = None

    monkeypatch.setattr(pseudolikelihood, "EPOCHS", 1)
    classes = pseudolikelihood.Classes(np.ones(pseudolikelihood.BUCKETS))
    Held.value = classes, pseudolikelihood.start(classes)
    import pyarrow as pa
    texts = ["one", "two words", "a few words more", "", "word " * 100]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["body"])
    out = list(pseudolikelihood._train(Held)(iter([batch])))
    assert out[0].column(0).to_pylist() == [1 + 2 + 4 + 100]
    rng = np.random.default_rng(1)  # slopes of the vectors around, added up one by one
    own, near = rng.integers(0, 128, 300), rng.integers(0, 128, (6, 300))
    given = pseudolikelihood.start(classes)
    weights, squares = [w.copy() for w in given], [np.full(w.shape, 1e-3, np.float32) for w in given]
    pseudolikelihood.train(weights, own, near, squares)
    h = pseudolikelihood.hidden(given, near)
    p = np.exp(h @ given[1].T + given[2])
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(300), own] -= 1
    slope = np.zeros_like(given[0])
    for j in range(6):
        np.add.at(slope[j], near[j], (p / 300 @ given[1]) * (1 - h * h))
    assert np.allclose(squares[0], 1e-3 + slope**2, atol=1e-6)


@pytest.mark.parametrize("max_shared", [lines.MAX_SHARED, 0])
def test_lines_are_dropped_where_the_texts_are_or_by_join(spark, max_shared):
    rng = random.Random(8)
    pool = [f"Line {i}  " for i in range(30)] + ["", "  ", "É", "é"]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(80)] + [None, "", "\n\n"]
    rows = [(t, i, f"keep {i}", -i, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, `my-col` string, n_lines long, high int").repartition(3)
    found = lines.dedup_lines(docs, min_docs=14, counts=("before", "gone"), max_shared=max_shared).collect()
    keys = [[re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")] for t in texts]
    often = {k for row in keys for k in row if k and sum(k in other for other in keys) >= 14}
    assert often and any(k and k not in often for row in keys for k in row)
    for r in found:
        left = [x for x, k in zip((texts[r.doc_id] or "").split("\n"), keys[r.doc_id]) if k not in often]
        assert (r.text, r.before, r.gone) == ("\n".join(left), len(keys[r.doc_id]), len(keys[r.doc_id]) - len(left))
        assert (r["my-col"], r.n_lines, r.high) == (f"keep {r.doc_id}", -r.doc_id, r.doc_id)
    assert len(found) == len(texts)
