"""Structured Streaming forms of keyed dedup, term trends and upserts."""
from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.keyed import first_per_key
from ..session import scratch_path


def file_stream(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def first_seen(stream: DataFrame, keys: list[str], ts: str, horizon: str) -> DataFrame:
    """One row per key; repeats within the horizon are dropped, state older than it is freed."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def daily_term_counts(stream: DataFrame, ts: str, term: str, lateness: str) -> DataFrame:
    """Counts per day and term. Trailing windows are sums of days, so state holds each event once."""
    return (
        stream.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"), F.col(term).alias("keyword"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("window.start").alias("date"), "keyword", "n")
    )


def sliding_term_counts(stream: DataFrame, ts: str, term: str, days: int, lateness: str) -> DataFrame:
    """Counts per sliding window of ``days`` days that moves by a day; final when the watermark passes."""
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{days} days", "1 day"), F.col(term).alias("keyword"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .select(F.to_date("window.start").alias("window_start"), "keyword", "occurrences")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_each_batch(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Last write wins, as a log of micro-batches: each writes its own partition and nothing else.

    A batch that runs again after a failure overwrites its own partition. ``current_rows`` resolves
    the log; ``compacted`` folds it into one table from time to time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row of every key in the log."""
    return first_per_key(spark.read.parquet(path), keys, [F.col("version").desc()])


def compacted(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """Writes the current rows as a table of its own; the log can start anew behind it."""
    current_rows(spark, path, keys).drop("version").write.mode("overwrite").parquet(target)


class LateRows(StreamingQueryListener):
    """Counts what event-time windows drop behind the watermark, per query: for aggregates these are groups of a task
    (window and term), not the rows behind them. The session calls it, whoever runs the query."""

    def __init__(self):
        self.dropped: Counter[str] = Counter()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, patience: float = 60.0) -> int:
        """What an ended query dropped in all its runs that this listener saw; events come in order, the end last."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(patience):
            raise TimeoutError("the end of the query was not reported")
        return self.dropped[str(query.id)]


def run_to_end(spark: SparkSession, label: str, start: Callable[[str, str], StreamingQuery]) -> str:
    """Runs a job over all input there is; returns the folder it wrote."""
    base = scratch_path(spark, label)
    start(f"{base}/out", f"{base}/state").awaitTermination()
    return f"{base}/out"
