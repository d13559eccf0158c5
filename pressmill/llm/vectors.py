"""Vector columns as numpy matrices, and partial results of partitions folded into one row."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.session import fan_out, materialize

#: partial results that one task folds in a round
FAN = 32


def usable(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows with a vector of finite numbers as ``array<double>``, and the length of the vectors.

    Vectors of another length than the most frequent one (of equally frequent ones the longest) and empty vectors are left out.
    """
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = rows.where(F.col(vector).isNotNull()).withColumn(vector, values).where(~odd & (F.size(values) > 0))
    lengths = found.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return found, 0
    return fan_out(found).where(F.size(vector) == lengths["d"]), lengths["d"]


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A list column of equally long lists as an n x d matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def scaled(column: pa.Array, d: int, scale: int, offset: int, limit: int) -> np.ndarray:
    """floor(scale * c) + offset of every entry, within ``limit`` on either side before the offset."""
    return np.clip(np.floor(matrix(column, d) * float(scale)), -limit, limit).astype(np.int64) + offset


def numbered(run: Callable[[Iterator[pa.RecordBatch]], dict], kinds: dict[str, pa.DataType]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: one row per partition with its number as ``slot`` and what ``run`` returns; none if that is empty."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = run(batches)
        if found:
            slot = {"slot": pa.array([TaskContext.get().partitionId()], pa.int64())}
            yield pa.RecordBatch.from_pydict(slot | {k: pa.array([v], kinds[k]) for k, v in found.items()})
    return whole


def folded(parts: DataFrame, fold: Callable[[pd.DataFrame], dict], fan: int = FAN) -> dict | None:
    """The rows of ``parts`` (slot and partial results) folded ``fan`` at a time, in the order of their slots, until one is left.

    Each round is a shuffle of partial results, whose number falls by the factor ``fan``; the driver gets one row.
    """
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slot")
        state = fold(group)
        return pd.DataFrame({"slot": [int(group["slot"].iloc[0]) // fan], **{k: [v] for k, v in state.items()}})

    parts = materialize(parts, "partial")
    left = parts.agg(F.count(F.lit(1)), F.max("slot")).first()
    while left[0] > 1:
        parts = materialize(parts.groupBy(F.floor(F.col("slot") / fan)).applyInPandas(run, parts.schema), "folded")
        left = parts.agg(F.count(F.lit(1)), F.max("slot")).first()
    row = parts.first()
    return None if row is None else row.asDict()
