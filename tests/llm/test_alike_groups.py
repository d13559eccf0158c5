"""Texts that share many parts are compared in one group."""
import random

from pressmill.llm import alike
from pressmill.llm.components import components
from pressmill.session import materialize


def test_same_texts_are_compared_once(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    copies = []
    for k in range(3):
        words = list(base)
        words[rng.randrange(400)] = f"other{k}"
        copies.append(" ".join(words))
    rows = materialize(spark.createDataFrame([*enumerate(copies), (9, "own words of a text that is like no other one")], "n long, text string"), "rows")
    kept = {}
    monkeypatch.setattr(alike, "materialize", lambda df, label: kept.setdefault(label, materialize(df, label)))
    links = alike.similar_links(rows, "n").collect()
    near = {frozenset((r["a"], r["b"])) for r in links}
    assert len(near) == 2 and frozenset().union(*near) == {0, 1, 2}
    groups = {}
    for r in kept["met"].collect():
        groups.setdefault((r["key"], r["sub"]), []).append(r["rep"])
    members = sorted(tuple(sorted(g)) for g in groups.values())
    assert (0, 1, 2) in members and len(members) == len(set(members)) <= 4


def copies(rng, n, length):
    """Texts in pairs that differ in one word."""
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(length)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    return texts


def test_texts_and_sets_are_not_joined_with_groups(spark):
    rows = materialize(spark.createDataFrame(list(enumerate(copies(random.Random(4), 600, 40))), "n long, text string"), "rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        links = alike.similar_links(rows, "n")
        plan = links._jdf.queryExecution().executedPlan().toString()
        found = {frozenset((r["a"], r["b"])) for r in links.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sent = plan[plan.rindex("Union"):]
    assert sent.count("MapInArrow") == 2 and "SortMergeJoin" not in sent.split("MapInArrow", 1)[1]
    assert found == {frozenset((2 * k, 2 * k + 1)) for k in range(600)}


def test_crowded_parts_and_full_filters(spark):
    """Members of crowded parts, and more members than the filter holds, go to the same groups."""
    rng = random.Random(5)
    crowd = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    texts = copies(rng, 40, 60) + [" ".join([*crowd[:k], f"own{k}", *crowd[k + 1:]]) for k in range(0, 300, 5)]
    rows = materialize(spark.createDataFrame(list(enumerate(texts)), "n long, text string"), "rows")
    edges = {words: alike.similar_links(rows, "n", group=8, max_words=words) for words in (alike.bloom.MAX_WORDS, 1)}
    found = {words: {r["node"]: r["component"] for r in components(e).collect()} for words, e in edges.items()}
    assert found[1] == found[alike.bloom.MAX_WORDS]
    assert all(found[1][2 * k] == found[1][2 * k + 1] == 2 * k for k in range(40)) and len(found[1]) == len(texts)
