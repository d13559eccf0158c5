"""Best-fit packing of documents into bins under conflicts.

Texts longer than a bin are cut into pieces of the bin's capacity. Pieces are dealt by hash to shards of bounded size,
and a shard packs its pieces from the longest on. Open bins are ordered by residual room and carry one bitmap of the
sources and duplicate clusters they hold. A piece goes to the successor of its length in that order, the search going
on until the tightest bin without a conflict is found; with none, a bin is opened. Two pieces of one source, or of one
cluster, never share a bin.

A hot source or cluster is spread over all shards by the hash; it costs bins, as the conflict demands, but never one task.

Defined results: a text that is null or without words gives one row without a bin (bin_id null, n_words 0); a null source
or cluster conflicts with nothing; repeated rows are packed each; without rows there are none.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.words import slices, utf8
from pressmill.session import materialize

CAPACITY = 2048
SHARD_PIECES = 4096


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, and a hash of their sequence: texts equal but for white space are one cluster."""
    for batch in (part for whole in batches for part in slices(whole)):
        words = [body.as_py().split() for body in batch.column(1)]
        digest = np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words], np.uint64).view(np.int64)
        n = pa.array([len(w) for w in words], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(digest)], ["doc", "length", "cluster"])


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each piece; pieces come in the order in which they are packed."""
    bits: dict[tuple[int, object], int] = {}
    for kind, values in enumerate((sources, clusters)):
        for value, n in Counter(values).items():
            if value is not None and n > 1:  # a value met once conflicts with nothing
                bits[kind, value] = 1 << len(bits)
    held: list[int] = []
    order: list[tuple[int, int]] = []  # (residual, bin)
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        mask = bits.get((0, source), 0) | bits.get((1, cluster), 0)
        at = bisect_left(order, (length, -1))
        while at < len(order) and held[order[at][1]] & mask:
            at += 1
        if at < len(order):
            residual, number = order.pop(at)
            held[number] |= mask
        else:
            residual, number = capacity, len(held)
            held.append(mask)
        if residual > length:
            insort(order, (residual - length, number))
        placed.append(number)
    return placed


def _packed(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        bins = best_fit(*[group.column(c).to_pylist() for c in ("length", "source", "cluster")], capacity)
        shard = group.column("shard")[0].as_py()
        return pa.table({"row": group.column("row"), "piece": group.column("piece"), "length": group.column("length"),
                         "bin_id": pa.array([(shard << 24) + b for b in bins], pa.int64())})
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(row, piece, length, bin_id) for written ``pieces`` (row, piece, length from 1 to capacity, source, cluster)."""
    shards = -(-pieces.count() // shard_pieces) or 1
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_packed(capacity), "row long, piece long, length long, bin_id long")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     cluster_col: str | None = None, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: (id, piece, first_word, n_words, bin_id). Clusters are texts of equal words unless a column names them."""
    named = F.struct(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                     (F.col(cluster_col) if cluster_col else F.lit(None)).cast("string").alias("given")).alias("doc")
    read = docs.select(named, utf8(text_col).alias("body"))
    sized = read.mapInArrow(_measured, f"doc {read.schema['doc'].dataType.simpleString()}, length long, cluster long")
    cluster = F.col("doc.given") if cluster_col else F.col("cluster").cast("string")
    sized = materialize(sized.select(F.monotonically_increasing_id().alias("row"), "doc.id", "doc.source", cluster.alias("cluster"), "length"), "sizes")
    cut = sized.where("length > 0").select("row", "source", "cluster", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / capacity))).alias("piece"))
    pieces = cut.select("row", "piece", F.least(F.lit(capacity).cast("long"), F.col("length") - F.col("piece") * capacity).alias("length"),
                        "source", "cluster")
    bins = pack(pieces, capacity, shard_pieces)
    return sized.select("row", F.col("id").alias(id_col)).join(bins, "row", "left").select(
        id_col, F.coalesce("piece", F.lit(0)).alias("piece"), (F.coalesce("piece", F.lit(0)) * capacity).alias("first_word"),
        F.coalesce("length", F.lit(0)).alias("n_words"), "bin_id")
