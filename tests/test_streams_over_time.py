"""Streams that run in several landings: dedup without a horizon, sliding windows with late rows."""
import datetime as dt
import os

from pyspark.sql import functions as F

from pressmill.operators.keyed import first_per_key, new_articles
from pressmill.streaming import ever, jobs

START = dt.datetime(2026, 1, 1)
SCHEMA = "k string, ts timestamp, no int"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def day(n, hour=0):
    return START + dt.timedelta(days=n, hours=hour)


LANDINGS = [
    [("a", day(0, 5), 1), ("a", day(0, 1), 2), ("b", day(0), 3), (None, day(0), 4), ("s", day(0), 5)],
    [("a", day(60), 6), ("c", day(60), 7), ("c", day(60), 8), (None, day(61), 9)],
    [("b", day(120), 10), ("d", day(2), 11), ("c", day(0), 12), ("a", day(120), 13), ("é", day(120), 14)],
]


def first_ever(spark, folder, log, state, stored):
    stream = jobs.file_stream(spark, folder, SCHEMA)
    ever.first_ever(stream, log, ["k"], [F.col("ts"), F.col("no")], state, stored, buckets=4).awaitTermination()
    return sorted((r["k"] or "-", r["no"]) for r in spark.read.parquet(log).collect())


def test_dedup_without_horizon_equals_the_batch(spark, tmp_path):
    folder, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    stored = spark.createDataFrame([("s",), ("zzz",)], "k string")
    got = None
    for rows in LANDINGS:
        land(spark, folder, rows)
        got = first_ever(spark, folder, log, state, stored)
    assert got == [("-", 4), ("a", 2), ("b", 3), ("c", 7), ("d", 11), ("é", 14)]
    # the same rows one batch after the other against what is stored
    kept = None
    for rows in LANDINGS:
        batch = spark.createDataFrame([r for r in rows if r[0]], SCHEMA)
        seen = stored if kept is None else stored.unionByName(kept.select("k"))
        new = first_per_key(new_articles(batch.withColumn("order", F.struct("ts", "no")), seen, "k", "order"), ["k"], [F.col("ts"), F.col("no")])
        kept = new if kept is None else kept.unionByName(new)
    assert sorted((r["k"], r["no"]) for r in kept.collect()) == got[1:]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    folder, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    for rows in LANDINGS[:2]:
        land(spark, folder, rows)
        want = first_ever(spark, folder, log, state, None)
    commits = os.path.join(state, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):  # as if the job had died after writing, before the commit
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    assert first_ever(spark, folder, log, state, None) == want
    assert [r["n"] for r in spark.read.parquet(log).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()] == [1] * len(want)


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    folder, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    for rows in LANDINGS[:2]:
        land(spark, folder, rows)
        first_ever(spark, folder, log, state, None)
    earlier = spark.read.parquet(log).where((F.col("version") < 5) & F.col("bucket").isin(1))
    assert "PartitionFilters: [isnotnull(version" in earlier._jdf.queryExecution().toString()


def test_sliding_windows_count_late_rows(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        seen = []
        for rows in ([("a", day(n), n) for n in range(10)],
                     [("a", day(11), 11), ("b", day(12), 12)],
                     # the watermark is at day 11: of the first row's seven windows all are past, of the second's three
                     [("a", day(1), 20), ("b", day(8, 3), 21), ("a", day(12, 1), 22)]):
            land(spark, folder, rows)
            query = jobs.append_to(jobs.sliding_term_counts(jobs.file_stream(spark, folder, SCHEMA), "ts", "k", 7, "1 day"), out, state)
            seen.append(late.of(query))
    finally:
        spark.streams.removeListener(late)
    assert seen == [0, 0, 7 + 3]
    got = {(str(r["window_start"]), r["keyword"]): r["occurrences"] for r in spark.read.parquet(out).collect()}
    assert got["2026-01-01", "a"] == 7 and got["2025-12-27", "a"] == 2  # without the late row
    assert ("2026-01-02", "b") not in got  # its only row was late for this window
    assert max(start for start, _ in got) == "2026-01-05"  # windows that end on day 11 at the latest are final
