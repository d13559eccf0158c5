"""Links between texts whose sets of word shingles are similar (Jaccard), for grouping near copies.

One 64-bit SimHash can't tell texts of similarity 0.8 from others: their fingerprints differ in about 7 to 11 bits. So the
shingles of a text are dealt by hash to parts of a few shingles each, as many as the text's size class has, and each of
up to ``PARTS`` parts gets an order-free fingerprint of its own. An edit changes only the parts that its shingles are in:
of two texts of similarity 0.8 each part is equal with probability 0.4, so that all of 16 differ once in some 4,000
pairs; texts of 0.9 once in 10^7. Texts with an equal part are compared by all of their shingles. Large sets are cut into
ranges of the hash, as many as the size class of the part needs for some ``RANGE`` shingles each, and the shared ones are
summed over the ranges of a group.

A part shared by more than ``GROUP`` texts is dealt by hash to groups of that size. Texts that share many parts meet in
many different groups, so what is one large set of copies stays connected; no group grows with the data. Of groups of the same
texts one is compared.

Neither texts nor sets are joined with the groups: a broadcast filter of bounded size holds which part of which text is in a
group, and each set goes from where its text is read to its groups. What the filter lets through wrongly is compared like the
rest and makes no link. Where there are more members than it can hold, the sets are joined with them instead.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm import bloom
from pressmill.llm import words as W
from pressmill.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
PARTS = 16
GROUP = 256
RANGE = 1024


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of k following words; a shorter text is one shingle."""
    if not len(h):
        return h
    k = min(k, len(h))
    total = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[j:j + len(total)]
    return np.unique(W.mixed(total + np.uint64(k)))


def levels(n: int, similarity: float) -> list[int]:
    """Size classes of a set: two sets of that similarity have one in common."""
    return sorted({n.bit_length() - 1, int(n / similarity).bit_length() - 1})


def cuts(level: int) -> int:
    """Binary digits of the number of ranges that sets of a size class are cut into."""
    return max(0, level + 2 - RANGE.bit_length())


def parts(own: np.ndarray, level: int) -> np.ndarray:
    """Fingerprints of the parts that are not empty; the last six bits hold the cuts of the level."""
    number = 1 << max(0, level - (2 if level > 5 else 1))
    part = (own % np.uint64(number)).astype(np.int64)
    used = min(PARTS, number)
    own, part = own[part < used], part[part < used]
    total = np.zeros(used, np.uint64)
    np.add.at(total, part, W.mixed(own ^ np.uint64(0x5851F42D4C957F2D)))
    there = np.flatnonzero(np.bincount(part, minlength=used))
    print_of = W.mixed(total[there] + there.astype(np.uint64) * np.uint64(0xDA942042E4DD58B5) + np.uint64(level + 1))
    return (print_of & ~np.uint64(63) | np.uint64(cuts(level))).view(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, row in it, its shingles)."""
    for batch in batches:
        for low, high, data, bounds in W.slabs(batch.column(1)):
            h, first = W.hashed(data, bounds, W.SPACED)
            for row in range(high - low):
                yield batch, low + row, shingles(h[first[row]:first[row + 1]], k)


def _keys(k: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, keys = [], []
            for _, _, own in _texts([batch], k):
                whole.append(W.mixed(own).sum(dtype=np.uint64) + np.uint64(len(own)))
                keys.append(np.concatenate([parts(own, x) for x in levels(len(own), similarity)]) if len(own) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.array(whole, np.uint64).view(np.int64)),
                W.lists(np.concatenate(keys) if keys else np.zeros(0, np.int64), np.cumsum([0, *map(len, keys)]), pa.int64())],
                ["row", "whole", "keys"])
    return run


def _sets(k: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, cut, span, bounds, out = [], [], [], [], [0], []
            for _, row, own in _texts([batch], k):
                fine = cuts(levels(len(own), similarity)[-1]) if len(own) else 0
                spans = (own >> np.uint64(64 - fine)).astype(np.int64) if fine else np.zeros(len(own), np.int64)
                begins = np.flatnonzero(np.diff(spans, prepend=-1))  # own is in order
                rows += [batch.column(0)[row].as_py()] * len(begins)
                keys += [np.concatenate([parts(own, x) for x in levels(len(own), similarity)])] * len(begins) if len(own) else []
                cut += [fine] * len(begins)
                span += spans[begins].tolist()
                bounds += (bounds[-1] + np.r_[begins[1:], len(own)]).tolist() if len(own) else []
                out.append(own)
            whole = pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), W.lists(np.concatenate(keys) if keys else np.zeros(0, np.int64), np.cumsum([0, *map(len, keys)]), pa.int64()),
                pa.array(cut, pa.int32()), pa.array(span, pa.int64()),
                W.lists(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64), np.array(bounds), pa.int64())],
                ["rep", "keys", "fine", "span", "own"])
            yield from W.slices(whole)
    return run


class Overlaps:
    """How many shingles the texts of a group share, summed over ranges of hashes."""

    def __init__(self) -> None:
        self.number: dict[int, int] = {}  # of each text's row
        self.sizes = np.zeros(8)
        self.both = np.zeros((8, 8))

    def add(self, rows: list[int], sets: list[np.ndarray]) -> None:
        """All shingles of one range; a row may come with more than one piece of it."""
        texts = sorted({self.number.setdefault(r, len(self.number)) for r in rows})
        n = len(self.number)
        if n > len(self.sizes):
            more = max(n, 2 * len(self.sizes)) - len(self.sizes)
            self.sizes, self.both = np.pad(self.sizes, (0, more)), np.pad(self.both, (0, more))
        local = {t: k for k, t in enumerate(texts)}
        member = np.repeat([local[self.number[r]] for r in rows], [len(s) for s in sets])
        self.sizes[texts] += np.bincount(member, minlength=len(texts))
        _, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[where] > 1
        columns = np.cumsum(times > 1) - 1
        member, column = member[shared], columns[where[shared]]
        order = np.argsort(column, kind="stable")
        member, column = member[order], column[order]
        both = np.zeros((len(texts), len(texts)), np.float32)  # counts of one range, exact
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (low, low + 4096))
            table = np.zeros((len(texts), min(4096, int(column[-1]) + 1 - low)), np.float32)
            table[member[a:b], column[a:b] - low] = 1
            both += table @ table.T
        self.both[np.ix_(texts, texts)] += both

    def stars(self, similarity: float) -> tuple[list[int], list[int]]:
        """Edges that connect what is similar in the group."""
        rows, n, a, b = list(self.number), len(self.number), [], []
        sizes, both = self.sizes[:n], self.both[:n, :n]
        near = both >= similarity * (sizes[:, None] + sizes - both) - 1e-6
        left = np.ones(n, bool)
        while left.any():
            first = int(left.argmax())
            left[first] = False
            front = np.flatnonzero(near[first] & left)
            while len(front):
                left[front] = False
                a += [rows[x] for x in front]
                b += [rows[first]] * len(front)
                front = np.flatnonzero(near[front].any(axis=0) & left)
        return a, b


def _stars(similarity: float):
    """Rows in order of group and range: one range of one group is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at, rows, sets = Overlaps(), None, [], []
        for batch in batches:
            a, b = [], []
            lists = batch.column(4)
            values, bounds = np.asarray(lists.flatten()), np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))]
            places = zip(*(batch.column(c).to_pylist() for c in range(4)))
            for k, (key, sub, span, rep) in enumerate(places):
                if at != (key, sub, span):
                    if rows:
                        group.add(rows, sets)
                    if at is not None and at[:2] != (key, sub):
                        for edges, more in zip((a, b), group.stars(similarity)):
                            edges += more
                        group = Overlaps()
                    at, rows, sets = (key, sub, span), [], []
                rows.append(rep)
                sets.append(values[bounds[k]:bounds[k + 1]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if rows:
            group.add(rows, sets)
            a, b = group.stars(similarity)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def similar_links(rows: DataFrame, row_col: str, text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY,
                  group: int = GROUP, max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """Edges (a, b) of row numbers that connect similar texts. Texts of equal shingles hang on one of them; texts without words
    are linked to nothing. ``rows`` is written and ``row_col`` unique in it."""
    dealt_to, member = F.pmod(F.xxhash64("key", "rep"), F.col("deal")), F.xxhash64("rep", "key")
    read = rows.select(F.col(row_col).cast("long").alias("row"), W.utf8(text_col).alias("body"))
    keyed = materialize(read.mapInArrow(_keys(shingle, similarity), "row long, whole long, keys array<long>"), "parts").where(F.size("keys") > 0)
    same = materialize(keyed.groupBy("whole").agg(F.min("row").alias("rep")), "same")
    equal = keyed.select("row", "whole").join(same, "whole").where("row <> rep").select(F.col("row").alias("a"), F.col("rep").alias("b"))
    single = keyed.join(same.select(F.col("rep").alias("row")), "row").select(F.col("row").alias("rep"), F.explode("keys").alias("key"))
    sizes = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = single.join(sizes, "key").withColumn("deal", F.ceil(F.col("n") / group)).withColumn("sub", dealt_to)
    # near copies share many parts: the same texts are compared in one group only, as their shingles are long
    groups = dealt.groupBy("key", "sub").agg(F.sort_array(F.collect_set("rep")).alias("reps"), F.max("deal").alias("deal")).where(F.size("reps") > 1)
    once = groups.groupBy("reps").agg(F.min(F.struct("key", "sub", "deal")).alias("at"))
    met = materialize(once.select("at.*", F.explode("reps").alias("rep")), "met")
    members = met.count()
    # one filter of the texts that are in groups and of their parts that are
    words = bloom.filter_words(2 * members, max_words)
    marks = met.select(F.explode(F.array(F.xxhash64("rep"), member)).alias("mark")).distinct()
    filters = materialize(bloom.build(marks, "mark", words), "bloom")
    held = bloom.suspected(read.withColumn("mark", F.xxhash64("row")), "mark", filters, words, seen="once").where("suspected").select("row", "body")
    sets = held.mapInArrow(_sets(shingle, similarity), "rep long, keys array<long>, fine int, span long, own array<long>")
    if 2 * members * bloom.BITS_PER_KEY <= max_words * 64:
        of_part = sets.select("rep", F.explode("keys").alias("key"), "fine", "span", "own").withColumn("mark", member)
        own = bloom.suspected(of_part, "mark", filters, words, seen="once").where("suspected")
        crowded = materialize(met.where("deal > 1").select("key", "deal").distinct(), "crowded")
        sent = own.join(crowded, "key", "left").withColumn("deal", F.coalesce("deal", F.lit(1).cast("long"))).withColumn("sub", dealt_to)
    else:
        sent = met.join(materialize(sets.drop("keys"), "sets"), "rep")
    span = F.expr("shiftright(span, cast(fine - (key & 63) as int))")  # the ranges of the key's level
    pieces = sent.select("key", "sub", span.alias("span"), "rep", "own")
    near = pieces.repartition("key", "sub").sortWithinPartitions("key", "sub", "span").mapInArrow(_stars(similarity), "a long, b long")
    return equal.unionByName(near)
