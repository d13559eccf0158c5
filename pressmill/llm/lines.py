"""Removal of lines that repeat across documents.

A first pass hashes the lines of each document. Two Bloom filters, of hashes seen once and seen twice, tell which hashes
may repeat; only those are shuffled, counted exactly by document, and the first occurrence of each is found. The
documents then drop their repeated lines. Where these are few enough to be broadcast (``MAX_SHARED``, counted), a second
pass over the texts drops them where the texts are, and no text is shuffled; else, and where the first occurrence stays, each
document is joined with its lines.

Defined results: a null or empty text is one empty line; lines whose key is empty stay; a line counts once for each row
that has it, so repeated rows count; without rows there are none; other columns keep their values, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm import bloom
from pressmill.llm.words import list_of, lists, quoted, schema, slices, utf8, whole_row
from pressmill.session import materialize, recorded_scratch, remove_scratch

MIN_DOCS = 10
STRIPPED = b" \t\n\x0b\x0c\r"
ROW = "_row"
#: 2^20 lines are 16 MB: the proven size of the broadcast
MAX_SHARED = 1 << 20


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()  # bytes: A-Z only


def _digests(body: bytes) -> np.ndarray:
    """Two 64-bit halves of a 128-bit hash for each line; zeros for an empty key."""
    keys = map(line_key, body.split(b"\n"))
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k) if k else bytes(16) for k in keys), ">i8").astype(np.int64).reshape(-1, 2)


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        found = [np.unique(d[d.any(axis=1)], axis=0) for d in (_digests(b) for b in batch.column(1).to_pylist())]
        flat = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        bounds = np.cumsum([0, *map(len, found)])
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(flat[:, 0], bounds, pa.int64()), lists(flat[:, 1], bounds, pa.int64())],
                                         [ROW, "high", "low"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        texts, total, gone = [], [], []
        for k, body in enumerate(batch.column(1).to_pylist()):
            split = body.split(b"\n")
            total.append(len(split))
            if batch.column(2)[k].is_valid:
                bad = set(zip(list_of(batch.column(2), k).tolist(), list_of(batch.column(3), k).tolist()))
                kept = [line for line, key in zip(split, _digests(body).tolist()) if tuple(key) not in bad]
                body = b"\n".join(kept)
                gone.append(len(split) - len(kept))
            else:
                gone.append(0)
            texts.append(body)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                         ["doc", "body", "n_lines", "n_dropped"])


def _without_shared(held):
    """Drops lines of a broadcast set, whose hashes are sorted by their halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = held.value
        for batch in (part for whole in batches for part in slices(whole)):
            texts, total, gone = [], [], []
            for body in batch.column(1).to_pylist():
                split = body.split(b"\n")
                total.append(len(split))
                keys = np.ascontiguousarray(_digests(body)).view([("high", np.int64), ("low", np.int64)]).ravel()
                at = np.minimum(np.searchsorted(shared, keys), max(0, len(shared) - 1))
                drop = shared[at] == keys if len(shared) else np.zeros(len(keys), bool)
                gone.append(int(drop.sum()))
                texts.append(b"\n".join([line for line, bad in zip(split, drop.tolist()) if not bad]) if gone[-1] else body)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             ["doc", "body", "n_lines", "n_dropped"])
    return run


def shared_lines(hashes: DataFrame, min_docs: int, max_words: int = bloom.MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lines of rows that may repeat: row, high, low; written lines that at least ``min_docs`` rows share: high, low, docs, and
    ``first``, the smallest row number with it). ``hashes`` has arrays high and low of distinct lines."""
    pairs = hashes.select(ROW, F.explode(F.arrays_zip("high", "low")).alias("line")).select(ROW, "line.high", "line.low")
    n = hashes.agg(F.coalesce(F.sum(F.size("high")), F.lit(0))).first()[0]
    words = bloom.filter_words(n, max_words)
    filters = materialize(bloom.build(pairs, "high", words), "bloom")
    maybe = bloom.suspected(pairs, "high", filters, words).where("suspected").drop("suspected")
    # written, so that a join with it meets two plain shuffles, of which Spark splits a hot line
    shared = materialize(maybe.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("docs"), F.min(ROW).alias("first")).where(F.col("docs") >= min_docs), "shared")
    return maybe, shared


def repeated_lines(hashes: DataFrame, min_docs: int, max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """(row, high, low, first): the lines of each row that at least ``min_docs`` rows share, and whether it is the first row
    (smallest row number) with it."""
    maybe, shared = shared_lines(hashes, min_docs, max_words)
    return maybe.join(shared, ["high", "low"]).select(ROW, "high", "low", (F.col(ROW) == F.col("first")).alias("first"))


def _joined(docs: DataFrame, text_col: str, min_docs: int, keep_first: bool, max_words: int) -> DataFrame:
    """(doc, body, high, low): each document with the lines it drops."""
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias(ROW), whole_row(docs).alias("doc")), "numbered")
    body = utf8(f"doc.{quoted(text_col)}").alias("body")
    hashes = numbered.select(ROW, body).mapInArrow(_line_hashes, f"{ROW} long, high array<long>, low array<long>")
    gone = repeated_lines(materialize(hashes, "lines"), min_docs, max_words)
    gone = gone.where(~F.col("first")) if keep_first else gone
    drops = gone.groupBy(ROW).agg(F.collect_list(F.struct("high", "low")).alias("lines"))
    return numbered.join(drops, ROW, "left").select("doc", body, F.col("lines.high").alias("high"), F.col("lines.low").alias("low"))


def dedup_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, keep_first: bool = False,
                max_words: int = bloom.MAX_WORDS, counts: tuple[str, str] = ("n_lines", "n_dropped"), max_shared: int = MAX_SHARED) -> DataFrame:
    """``docs`` with the text less its repeated lines, and two counts, of lines before and of those dropped, which replace columns
    of that name. With ``keep_first`` the first row that has a repeated line keeps it; ``docs`` is read twice."""
    spark = docs.sparkSession
    row, keys = whole_row(docs, text_col), None
    if not keep_first:
        with recorded_scratch() as spent:
            hashes = docs.select(F.monotonically_increasing_id().alias(ROW), utf8(quoted(text_col)).alias("body")).mapInArrow(
                _line_hashes, f"{ROW} long, high array<long>, low array<long>")
            _, shared = shared_lines(materialize(hashes, "lines"), min_docs, max_words)
            if shared.count() <= max_shared:
                found = shared.select("high", "low").toArrow()
                keys = np.empty(found.num_rows, [("high", np.int64), ("low", np.int64)])
                keys["high"], keys["low"] = np.asarray(found["high"]), np.asarray(found["low"])
        remove_scratch(spark, spent)
    if keys is not None:
        read, run = docs.select(row.alias("doc"), utf8(quoted(text_col)).alias("body")), _without_shared(spark.sparkContext.broadcast(np.sort(keys)))
    else:
        joined = _joined(docs, text_col, min_docs, keep_first, max_words)
        rest = F.col("doc").dropFields(quoted(text_col)) if len(docs.columns) > 1 else F.struct(F.lit(1).alias("_"))
        read, run = joined.select(rest.alias("doc"), "body", "high", "low"), _without
    kept = read.mapInArrow(run, schema(("doc", read.schema["doc"].dataType), ("body", "binary"), ("n_lines", "long"), ("n_dropped", "long")))
    columns = [F.col("body").cast("string").alias(c) if c == text_col else F.col(f"doc.{quoted(c)}") for c in docs.columns if c not in counts]
    return kept.select(*columns, F.col("n_lines").alias(counts[0]), F.col("n_dropped").alias(counts[1]))
