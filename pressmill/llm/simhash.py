"""Near-duplicate groups by 64-bit SimHash and covering locality-sensitive hashing.

For radius r every bit position i gets a vector m(i) of r + 1 bits; the table of a vector v keeps the positions whose
m(i) has odd parity with v. At most r differing positions give at most r linear conditions on v, so some non-zero v has
even parity with all of them: its table (one of 2^(r+1) - 1) drops all differing positions and the pair collides there.

Equal fingerprints are one class. A bucket with more classes than ``BUCKET`` is hashed again by other covering masks on
top of its own, until no bucket can hold more (the kept bits leave too few values). A bucket yields a spanning star of
each of its linked sets, never its pairs; components are then joined in rounds.

Defined results: a null text has no words, so fingerprint 0; a null id never names a component that has another; a
component of null ids has a null name; repeated rows each get a row; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.alike import SIMILARITY, similar_links
from pressmill.llm.components import components
from pressmill.llm.words import list_of, utf8
from pressmill.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 1024


def fingerprint(body: bytes, shingle: int = SHINGLE) -> bytes:
    """Eight bytes, the highest bit first, of the UTF-8 text ``body``."""
    words = body.lower().split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())])
    ones = np.zeros(64, np.int64)
    bits = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for low in range(0, n, 1 << 16):
        ones += np.unpackbits(bits[low:low + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n).tobytes()


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join([fingerprint(body.as_py(), shingle) for body in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(prints, ">i8").astype(np.int64))], ["id", "fp"])
    return run


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """The kept positions of each table; levels differ in how vectors are dealt to positions."""
    tables = 2 ** (radius + 1) - 1
    dealt = np.random.default_rng(level).permutation(64) % tables + 1
    return [sum(1 << i for i in range(64) if (int(dealt[i]) & v).bit_count() % 2) for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _stars(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for k in range(batch.num_rows):
                own = np.sort(list_of(batch.column(0), k))
                near = np.bitwise_count((own[:, None] ^ own).view(np.uint64)) <= radius
                left = np.ones(len(own), bool)
                while left.any():
                    first = int(left.argmax())
                    left[first] = False
                    front = np.flatnonzero(near[first] & left)
                    while len(front):
                        left[front] = False
                        a += own[front].tolist()
                        b += [int(own[first])] * len(front)
                        front = np.flatnonzero(near[front].any(axis=0) & left)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct values of ``prints`` (column fp) within ``radius``, and none beyond a chain of them."""
    rows = prints.select("fp", F.lit(0).cast("long").alias("kept"))
    edges = None
    for level in range(64):
        masks = F.array(*[F.lit(_signed(m)).cast("long") for m in covering_masks(radius, level)])
        rows = rows.select("fp", F.explode(masks).alias("mask"), "kept").select("fp", F.col("kept").bitwiseOR(F.col("mask")).alias("kept")).distinct()
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("kept")))
        sizes = rows.groupBy("kept", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = materialize(rows.join(sizes, ["kept", "key"]), "buckets")
        small = rows.where(F.col("n") <= bucket).groupBy("kept", "key").agg(F.collect_list("fp").alias("fps"))
        found = small.select("fps").mapInArrow(_stars(radius), "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        rows = rows.where(F.col("n") > bucket).select("fp", "kept")
        if rows.isEmpty():
            break
    return edges


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                bucket: int = BUCKET) -> DataFrame:
    """One row per document: (id, fingerprint in hex, component_id)."""
    read = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("body"))
    rows = materialize(read.mapInArrow(_fingerprints(shingle), "id long, fp long"), "prints")
    named = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    labels = components(links(named.select("fp"), radius, bucket)).withColumnRenamed("node", "fp")
    known = named.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = materialize(known.join(least, "component").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def copy_groups(rows: DataFrame, row_col: str, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(row, group): fingerprint groups joined where texts of two groups are similar in their five-word shingles.

    ``rows`` is written and ``row_col`` unique in it. Fingerprints within the radius find texts that are all but equal; the
    links of ``alike`` add those that are similar to the given degree."""
    groups = materialize(near_groups(rows, row_col, text_col).select(F.col(row_col).alias("row"), F.col("component_id").alias("near")), "groups")
    ends = {c: groups.select(F.col("row").alias(c), F.col("near").alias(f"near_{c}")) for c in "ab"}
    crossing = similar_links(rows, row_col, text_col, similarity=similarity).join(ends["a"], "a").join(ends["b"], "b").select(
        F.col("near_a").alias("a"), F.col("near_b").alias("b")).where("a <> b").distinct()
    joined = materialize(components(crossing), "joined").withColumnRenamed("node", "near")
    return groups.join(joined, "near", "left").select(F.col("row").alias(row_col), F.coalesce("component", "near").alias("group"))
