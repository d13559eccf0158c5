"""Keyed dedup of a stream without a horizon: exact over all time, as a batch against everything stored would be.

What was let through is the state: a log with one version per micro-batch, by buckets of the key. A batch keeps the first row
per key, in the order given, and leaves out keys that are stored or stand in an earlier version; of the log it reads the
buckets its keys fall in, and of these the key columns. A batch that runs again after a failure sees the versions before its
own only and replaces its own, so the log never has a key twice. A log that has grown long is folded with ``jobs.compacted``
and handed to a new one as ``stored``.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import first_per_key
from ..session import materialize
from ..sources.landed import exists
from ..sources.tables import bucket_of

BUCKETS = 64


def without_keys(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored; null is a key like any other."""
    known = stored.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(Column.__and__, [rows[k].eqNullSafe(known[f"_known_{k}"]) for k in keys])
    return rows.join(known, same, "left_anti")


def first_ever(
    stream: DataFrame, log: str, keys: list[str], order: list[Column], checkpoint: str, stored: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Appends to ``log`` the first row of every key that was never seen before; ``stored`` has keys seen elsewhere."""
    known = T.StructType([*stream.select(*keys).schema, T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = first_per_key(batch, keys, order).withColumn("bucket", bucket_of(keys, buckets))
        rows = materialize(first, "arrived")
        if stored is not None:
            rows = without_keys(rows, stored, keys)
        if exists(spark, log):
            touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
            earlier = spark.read.schema(known).parquet(log).where((F.col("version") < batch_id) & F.col("bucket").isin(*touched))
            rows = without_keys(rows, earlier, keys)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{log}/version={batch_id}")

    return (
        stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
