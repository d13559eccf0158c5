"""Hard negatives by rotated one-bit codes.

A vector is turned by a random rotation and coded as signs; the code-vector alignment, its product with the unit vector of the
signs, is stored with it. What the signs leave over is turned and coded again, ``LEVELS`` times in all, and the length of the
last rest is stored too. For an anchor, which is turned alike and cut into bit planes, popcounts of code and planes estimate
the score, and by Cauchy-Schwarz the rest can change it by no more than the product of the lengths. Rows whose interval cannot reach what is
asked for are left out for certain; the others are scored in whole numbers. So results are exact.

The anchors are a stated query set: they go to the rows in blocks of bounded size, a partition keeps the best few rows per
anchor, and only these are shuffled. First come the positives of each anchor, then the negatives inside the window of scores
that each positive opens.

Defined results: rows whose label or vector is null, or whose vector is empty or holds null or non-finite components, take no
part, nor do those of another length than most; components count as whole numbers within +-2^25; a null id is no anchor, and
comes last among equal scores; repeated rows are rows of their own, so a copy of the anchor can be its positive; an anchor
without positives, or a positive without negatives, has no rows; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.vectors import matrix, scaled, usable
from pressmill.session import materialize, scratch_path

SCALE, LIMIT = 256, 1 << 25
LEVELS = 6
PLANES = 8
SEED = 13
#: anchors that go to the rows at once, on average
BLOCK = 4096
#: anchors and rows whose estimates are made at once
ANCHOR_TILE, ROW_TILE = 128, 1024
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95

CODED = "row long, id long, label long, anchor boolean, v array<int>, code binary, align array<double>"
NULL_ID = np.iinfo(np.int64).max


def padded(d: int) -> int:
    return max(64, 1 << (d - 1).bit_length())


def widened(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), padded(x.shape[1])))
    out[:, :x.shape[1]] = x
    return out


def rotate(x: np.ndarray, level: int) -> np.ndarray:
    """Rows of ``x`` (a power of two long) turned by two rounds of random signs and a Walsh-Hadamard transform."""
    n, size = x.shape
    for signs in np.random.default_rng([SEED, level]).choice([-1.0, 1.0], (2, size)):
        x = x * signs
        step = 1
        while step < size:
            pair = x.reshape(n, -1, 2, step)
            x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
            step *= 2
        x = x / np.sqrt(size)
    return x


def encode(v: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(n x levels x words of bits, n x (levels + 1): alignments, length of the rest)."""
    left = widened(v)
    n, size = left.shape
    bits, align = np.empty((n, levels, size // 64), np.uint64), np.empty((n, levels + 1))
    for k in range(levels):
        left = rotate(left, k)
        positive = left >= 0
        bits[:, k] = np.packbits(positive, axis=1, bitorder="little").view(np.uint64)
        align[:, k] = np.abs(left).sum(axis=1) / np.sqrt(size)
        left = left - np.where(positive, 1.0, -1.0) * (align[:, k] / np.sqrt(size))[:, None]
    align[:, levels] = np.sqrt((left * left).sum(axis=1))
    return bits, align


class Planes:
    """Anchors, turned as the rows are at each level, as ``PLANES`` bit planes: w ~ low + step * sum of 2^j plane_j."""

    def __init__(self, v: np.ndarray, levels: int):
        w = widened(v)
        self.size = w.shape[1]
        self.length = np.sqrt((w * w).sum(axis=1))
        self.low, self.step, self.error, self.sum = (np.empty((levels, len(w))) for _ in range(4))
        self.bits = np.empty((levels, PLANES, len(w), self.size // 64), np.uint64)
        for k in range(levels):
            w = rotate(w, k)
            self.low[k] = w.min(axis=1)
            self.step[k] = np.maximum(w.max(axis=1) - self.low[k], 1e-300) / (2**PLANES - 1)
            cut = np.rint((w - self.low[k][:, None]) / self.step[k][:, None]).astype(np.uint8)
            near = self.low[k][:, None] + self.step[k][:, None] * cut
            self.error[k] = np.sqrt(((w - near) ** 2).sum(axis=1))
            self.sum[k] = near.sum(axis=1)
            for j in range(PLANES):
                self.bits[k, j] = np.packbits((cut >> j) & 1, axis=1, bitorder="little").view(np.uint64)

    def intervals(self, which: np.ndarray, bits: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated scores of rows (down) and anchors ``which`` (across), and how far off they can be."""
        n, levels, words = bits.shape
        estimate = np.zeros((n, len(which)))
        ones = np.bitwise_count(bits).sum(axis=2, dtype=np.int64)
        for k in range(levels):
            total = np.zeros((n, len(which)), np.int32)
            for j in range(PLANES):
                for w in range(words):
                    total += np.bitwise_count(bits[:, k, w][:, None] & self.bits[k, j, which, w]).astype(np.int32) << j
            marked = total * self.step[k, which] + np.multiply.outer(ones[:, k], self.low[k, which])
            estimate += (2 * marked - self.sum[k, which]) * (align[:, k] / np.sqrt(self.size))[:, None]
        off = np.multiply.outer(align[:, levels], self.length[which]) + align[:, :levels] @ self.error[:, which]
        return estimate, off + 1e-9 * (1 + np.multiply.outer(align.sum(axis=1), self.length[which]))


def _best(keys: list[np.ndarray], score: np.ndarray, id_: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` entries of each key by falling score, id and row."""
    order = np.lexsort([row, id_, -score, *reversed(keys)])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < most]


def _rows_of(batch: pa.RecordBatch, d: int, levels: int) -> tuple[np.ndarray, ...]:
    code = b"".join(batch.column("code").to_pylist())
    ids = batch.column("id")
    return (np.asarray(batch.column("row")), np.asarray(ids.fill_null(NULL_ID)), np.asarray(batch.column("label")),
            matrix(batch.column("v"), d).astype(np.int64),
            np.frombuffer(code, np.uint64).reshape(batch.num_rows, levels, padded(d) // 64), matrix(batch.column("align"), levels + 1))


def _scores(v: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [np.einsum("ij,ij->i", v[i[k:k + 65536]], anchors[j[k:k + 65536]]) for k in range(0, len(i), 65536)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _nearest(anchors: dict, d: int, levels: int, most: int):
    """For mapInArrow: the best ``most`` rows of one partition with the label of each anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, rows, labels, v = Planes(anchors["v"], levels), anchors["row"], anchors["label"], anchors["v"]
        held = [np.zeros(0, np.int64) for _ in range(4)]  # anchor, score, id, row
        least = np.full(len(rows), -np.inf)
        for whole in batches:
            for low in range(0, whole.num_rows, ROW_TILE):
                row, id_, label, vectors, bits, align = _rows_of(whole.slice(low, ROW_TILE), d, levels)
                found = [held]
                for name in np.unique(label):
                    mine, theirs = np.flatnonzero(label == name), np.flatnonzero(labels == name)
                    for at in range(0, len(theirs), ANCHOR_TILE):
                        which = theirs[at:at + ANCHOR_TILE]
                        estimate, off = planes.intervals(which, bits[mine], align[mine])
                        bar = least[which]
                        if len(mine) > most + 1:  # the anchor itself may be among them
                            bar = np.maximum(bar, np.partition(estimate - off, len(mine) - most - 1, axis=0)[len(mine) - most - 1])
                        i, j = np.nonzero(estimate + off >= bar)
                        i, j = mine[i], which[j]
                        other = row[i] != rows[j]
                        i, j = i[other], j[other]
                        found.append([j, _scores(vectors, v, i, j), id_[i], row[i]])
                held = [np.concatenate(parts) for parts in zip(*found)]
                keep = _best([held[0]], held[1], held[2], held[3], most)
                held = [part[keep] for part in held]
                full = np.bincount(held[0], minlength=len(rows)) >= most
                worst = np.full(len(rows), np.inf)
                np.minimum.at(worst, held[0], held[1].astype(np.float64))
                least = np.where(full, worst, -np.inf)
        null = held[2] == NULL_ID
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[held[0]]), pa.array(held[1]), pa.array(held[2], mask=null), pa.array(held[3])], ["anchor_row", "score", "id", "row"])
    return run


def _inside(anchors: dict, asked: dict, d: int, levels: int, most: int, least_share: int, most_share: int):
    """For mapInArrow: for each asked (anchor, positive) the best ``most`` rows of one partition with another label and a score
    in the window of the positive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, labels, v = Planes(anchors["v"], levels), anchors["label"], anchors["v"]
        of, positive = asked["anchor"], asked["score"]
        n = len(v)
        # the scores that any positive of an anchor admits, then what each still needs in this partition
        top, floor = np.full(n, -np.inf), np.full(n, np.inf)
        np.maximum.at(top, of, positive * (most_share / 100))
        need = positive * (least_share / 100)
        np.minimum.at(floor, of, need)
        first = np.searchsorted(of, np.arange(n + 1))
        held = [np.zeros(0, np.int64) for _ in range(4)]  # place in asked, score, id, row
        for whole in batches:
            for low in range(0, whole.num_rows, ROW_TILE):
                row, id_, label, vectors, bits, align = _rows_of(whole.slice(low, ROW_TILE), d, levels)
                found = [held]
                for at in range(0, n, ANCHOR_TILE):
                    which = np.arange(at, min(n, at + ANCHOR_TILE))
                    estimate, off = planes.intervals(which, bits, align)
                    i, j = np.nonzero((estimate + off >= floor[which]) & (estimate - off <= top[which]) & (label[:, None] != labels[which]))
                    j = which[j]
                    score = _scores(vectors, v, i, j)
                    for k in range(int((first[1:] - first[:-1]).max(initial=0))):
                        place = first[j] + k
                        there = place < first[j + 1]
                        p = place[there]
                        s, r = score[there], i[there]
                        fits = (least_share * positive[p] <= 100 * s) & (100 * s <= most_share * positive[p])
                        found.append([p[fits], s[fits], id_[r[fits]], row[r[fits]]])
                held = [np.concatenate(parts) for parts in zip(*found)]
                keep = _best([held[0]], held[1], held[2], held[3], most)
                held = [part[keep] for part in held]
                full = np.bincount(held[0], minlength=len(of)) >= most
                worst = np.full(len(of), np.inf)
                np.minimum.at(worst, held[0], held[1].astype(np.float64))
                floor = np.full(n, np.inf)
                np.minimum.at(floor, of, np.where(full, worst, need))
        null = held[2] == NULL_ID
        at = held[0]
        yield pa.RecordBatch.from_arrays([
            pa.array(asked["anchor_row"][at]), pa.array(asked["row"][at]), asked["anchor_id"].take(pa.array(at)), asked["id"].take(pa.array(at)),
            pa.array(positive[at]), pa.array(held[1]), pa.array(held[2], mask=null), pa.array(held[3])],
            ["anchor_row", "positive_row", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id", "row"])
    return run


def coded(rows: DataFrame, id_col: str, vector: str, label: str, anchors: Column, scale: int, levels: int) -> tuple[DataFrame, int]:
    """The written index: whole-number vectors with codes and alignments of every row that takes part, and their length."""
    picked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                         F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector).alias("v")).where("label IS NOT NULL")
    have, d = usable(picked, "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = scaled(batch.column("v"), d, scale, 0, LIMIT)
            bits, align = encode(v, levels)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * d), pa.array(v.astype(np.int32).ravel()))
            lengths = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * (levels + 1)), pa.array(align.ravel()))
            codes = pa.array([bits[k].tobytes() for k in range(len(v))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "id", "label", "anchor")], flat, codes, lengths], [f.split()[0] for f in CODED.split(", ")])

    have = have.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", "v")
    return materialize(have.mapInArrow(run, CODED) if d else rows.sparkSession.createDataFrame([], CODED), "codes"), d


def _first(rows: DataFrame, keys: list[str], score: str, id_: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(id_).asc_nulls_last(), "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST,
                   most_share: int = MOST, levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """For each of the ``anchors`` and each of its first ``positives`` rows of its label, the first ``negatives`` rows of other labels
    with a score between ``least_share`` and ``most_share`` percent of the positive's: (anchor_id, positive_id, rank, ...)."""
    spark = rows.sparkSession
    index, d = coded(rows, id_col, vector, label, anchors, scale, levels)
    questions = index.where("anchor").select("row", "id", "label", "v")
    blocks = -(-questions.count() // block)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    path, written = scratch_path(spark, "negatives"), False
    for k in range(blocks):  # a bounded block of anchors at a time meets all rows
        own = questions.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k).orderBy("row").toArrow()
        if not own.num_rows:
            continue
        held = {"row": np.asarray(own["row"]), "label": np.asarray(own["label"]), "v": matrix(own["v"], d).astype(np.int64)}
        near = index.mapInArrow(_nearest(held, d, levels, positives), "anchor_row long, score long, id long, row long")
        near = _first(near, ["anchor_row"], "score", "id", positives).orderBy("anchor_row", "rank").toArrow()
        if not near.num_rows:
            continue
        place = np.searchsorted(held["row"], np.asarray(near["anchor_row"]))
        asked = {"anchor": place, "anchor_row": held["row"][place], "row": np.asarray(near["row"]), "score": np.asarray(near["score"]),
                 "anchor_id": own["id"].combine_chunks().take(pa.array(place)), "id": near["id"].combine_chunks()}
        wide = index.mapInArrow(
            _inside(held, asked, d, levels, negatives, least_share, most_share),
            "anchor_row long, positive_row long, anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long, row long")
        best = _first(wide, ["anchor_row", "positive_row"], "negative_score", "negative_id", negatives)
        best.select(*[f.split()[0] for f in RESULT.split(", ")]).write.mode("append").parquet(path)
        written = True
    return spark.read.schema(RESULT).parquet(path) if written else spark.createDataFrame([], RESULT)
