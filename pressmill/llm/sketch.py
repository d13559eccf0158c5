"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the range of hashes. What is kept does not depend on the text it
stands in, so the sketch of several texts is the union of theirs, and the share of one sketch inside another estimates
containment, also for a note and a book. The estimate for a text of n shingles rests on about n / 8 hashes.

``edited_fingerprints`` compares each document with a version whose tail is replaced by the head of the next document. The
order of ids is cut into ranges by exact first keys; a range gets its rows and, as a guest, the first row of the next one, so
texts are shuffled once and every row meets its successor in the range.

Defined results: a null text counts as empty; a text of fewer words than a shingle has one shingle, of no words none; where
both sketches are empty the likeness is 1 for equal word sequences, else 0, and where one is, 0; a null id comes last; among
equal ids the hash of the text decides, and each repeated row gets a row; the only row is its own next; an empty table gives an
empty result; other columns are ignored. Rows with equal id and equal text stay in one range.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.words import ALNUM, hashed, mixed, slabs, slices, utf8

SHINGLE = 5
#: hashes have 47 bits; those below 2^44, an eighth, are kept: eleven hexadecimal digits each
HASH_BITS, KEPT_BITS = 47, 44
DIGITS = KEPT_BITS // 4

_FACTORS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


class Sketch:
    """Kept hashes, rising and distinct, with the number of shingles (repeats included) and a sum that tells shingle sets apart."""
    __slots__ = ("hashes", "n", "mark")

    def __init__(self, hashes: np.ndarray, n: int, mark: int):
        self.hashes, self.n, self.mark = hashes, n, mark

    def text(self) -> str:
        """``n:`` and the hashes in hexadecimal digits."""
        digits = np.frombuffer(self.hashes.astype(">u8").tobytes().hex().encode(), "S1").reshape(-1, 16)[:, 16 - DIGITS:]
        return f"{self.n}:{digits.tobytes().decode()}"


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of the smaller text's shingles inside the other text."""
    if len(a.hashes) and len(b.hashes):
        small, large = (a.hashes, b.hashes) if len(a.hashes) <= len(b.hashes) else (b.hashes, a.hashes)
        at = np.searchsorted(large, small)
        return float((large[np.minimum(at, len(large) - 1)] == small).mean())
    return float(not len(a.hashes) and not len(b.hashes) and (a.n, a.mark) == (b.n, b.mark))


def sketch_texts(column: pa.Array, size: int = SHINGLE) -> list[Sketch]:
    """The sketches of a binary Arrow column of UTF-8 texts."""
    out = []
    for _, _, data, bounds in slabs(column):
        h, first = hashed(data, bounds, ALNUM)
        total = np.zeros(max(0, len(h) - size + 1), np.uint64)
        for k in range(size):
            total += h[k:k + len(total)] * _FACTORS[k]
        total = mixed(total) >> np.uint64(64 - HASH_BITS)
        low = total < np.uint64(1 << KEPT_BITS)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                mine = total[a:b - size + 1]
                out.append(Sketch(np.unique(mine[low[a:b - size + 1]]), len(mine), int(mine.sum(dtype=np.uint64))))
            else:  # all words are one shingle, or there is none
                whole = mixed((h[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64, keepdims=True)) >> np.uint64(64 - HASH_BITS)
                kept = whole[whole < np.uint64(1 << KEPT_BITS)] if b > a else whole[:0]
                out.append(Sketch(kept, int(b > a), int(whole[0]) if b > a else 0))
    return out


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, hashes array<long>) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = sketch_texts(part.column(1), size)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([s.n for s in found], pa.int64()),
                    pa.array([s.hashes.astype(np.int64) for s in found], pa.list_(pa.int64()))], ["id", "n_shingles", "hashes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col)).mapInArrow(
        run, f"id {kind}, n_shingles long, hashes array<long>").withColumnRenamed("id", id_col)


def merged(found: DataFrame, key: Column) -> DataFrame:
    """The sketches of whole groups as rows (key, hash), each hash once."""
    return found.select(key.alias("key"), F.explode("hashes").alias("hash")).distinct()


def contained(inner: Column, outer: Column) -> Column:
    """Estimated share of the shingles of one sketch that are in another; null for an empty one."""
    return F.size(F.array_intersect(inner, outer)) / F.nullif(F.size(inner), F.lit(0))


KEY = ["last", "down", "tie"]
RESULT = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
          "edited_chars long")


def _edited(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row before: bucket, guest, id, text, sketch
        for batch in batches:
            for part in slices(batch, 64):
                texts = [t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                rows = list(zip(*[part.column(c).to_pylist() for c in ("bucket", "guest", "id")], texts, sketch_texts(part.column("text"), size)))
                rows = [held, *rows] if held else rows
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
                held = rows[-1]
                edited = [a[3][:len(a[3]) - len(a[3]) // 2] + b[3][:len(a[3]) // 2] for a, b in pairs]
                raw = [t.encode("utf-8", "replace") for t in edited]
                made = sketch_texts(pa.array(raw, pa.large_binary()), size)
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string()),
                    pa.array([a[4].text() for a, _ in pairs], pa.string()), pa.array([s.text() for s in made], pa.string()),
                    pa.array([likeness(a[4], s) for (a, _), s in zip(pairs, made)], pa.float64()),
                    pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
                    pa.array([len(t) for t in edited], pa.int64())], [f.split()[0] for f in RESULT.split(", ")])
    return run


def _packed(last: np.ndarray, down: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Keys as byte strings of the same order."""
    out = np.empty(len(last), [("last", "u1"), ("down", ">u8"), ("tie", ">u8")])
    sign = np.uint64(1 << 63)
    out["last"] = np.asarray(last, np.uint8) + 1
    out["down"] = np.asarray(down, np.int64).view(np.uint64) ^ sign
    out["tie"] = np.asarray(tie, np.int64).view(np.uint64) ^ sign
    return out.view("S17")


def _ranges(rows: DataFrame, parts: int) -> np.ndarray:
    """The first key of each of some ``parts`` ranges of about equally many rows; what the driver gets is a key per range."""
    ranged = rows.select(*KEY).repartitionByRange(parts, *KEY)
    found = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*KEY)).alias("first")).select("first.*").toPandas()
    return np.sort(_packed(*[found[c].to_numpy() for c in KEY]))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per document the fingerprints of its text and of its edited text, and how alike it is to that and to the next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_ = F.col(id_col).cast("long")
    rows = docs.select(
        id_.alias("id"), utf8(text_col).alias("text"), id_.isNull().alias("last"),
        F.coalesce(F.bitwise_not(id_), F.lit(0)).alias("down"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tie"))
    firsts = _ranges(rows, parts)
    if not len(firsts):
        return spark.createDataFrame([], RESULT).withColumnRenamed("id", id_col)

    @F.pandas_udf("array<int>")
    def places(last: pd.Series, down: pd.Series, tie: pd.Series) -> pd.Series:
        """The range of a row, and for the first row of a range also the one before it."""
        keys = _packed(last.to_numpy(), down.to_numpy(), tie.to_numpy())
        own = np.searchsorted(firsts, keys, "right") - 1
        return pd.Series([[b, (b - 1) % len(firsts)] if first else [b] for b, first in zip(own.tolist(), (firsts[own] == keys).tolist())])

    dealt = rows.select("*", F.posexplode(places(*KEY)).alias("guest", "bucket")).withColumn("guest", F.col("guest") == 1)
    ordered = dealt.repartitionById(len(firsts), "bucket").sortWithinPartitions("bucket", "guest", *KEY)
    return ordered.select("bucket", "guest", "id", "text").mapInArrow(_edited(size), RESULT).withColumnRenamed("id", id_col)
