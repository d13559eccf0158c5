"""Connected components of a graph given as edges, by alternating stars in joins and aggregates.

Each round writes its edges to the shared folder. Nodes are numbers; a component is named by its smallest node.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.session import materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition, batch by batch, as stars around the smallest node seen together."""
    for batch in batches:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        pairs = [(x, root(x)) for x in up]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: ``edges`` hang the larger neighbours (or all smaller ones and the node) on the smallest neighbour."""
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = ends.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge of ``edges`` (columns a, b)."""
    larger = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = materialize(larger.mapInArrow(_forest, "a long, b long").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        now = materialize(_star(_star(now, True), False), "edges")
    # a converged forest is made of stars: every edge joins a node with the smallest of its component
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
