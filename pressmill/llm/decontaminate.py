"""Benchmark decontamination by a positional inverted index.

``build_index`` stores the postings of every word of every document in a table: one row for a segment, a run of whole
documents of about 2 MB. A segment lists its distinct terms (64-bit word hashes, sorted) and, per term, the ascending
word positions in the segment, as gaps. ``search`` takes the test items in blocks of bounded size against all segments.
In a segment it orders the words of each test phrase by the length of their posting lists, takes the rarest list as
candidates (positions less the word's offset) and intersects it with the others, rarest first. With ``slop`` a word may
stand up to so many places off its own, seen from the rarest word (proximity); 0 is the exact phrase. Only matches are
shuffled.

Defined results: null and wordless texts have no words and no hits; an item without words matches nothing; an item of
null id is searched and its words are hit, but it can't be listed or counted; repeated items count once; repeated
documents or null ids each keep their own row; without items or documents the result has no hits or no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm import words as W
from pressmill.session import materialize, scratch_path

WINDOW = 10
SEGMENT_BYTES = 1 << 20
#: words of test items that are searched, and held in memory, at once
BLOCK_WORDS = 100_000
#: candidate places that one step of a search holds in memory
STEP = 1 << 20
INDEX_SCHEMA = "segment long, doc_ids array<long>, doc_words array<long>, terms array<long>, lengths array<int>, gaps array<int>"
HITS_SCHEMA = "segment long, place int, item_ids array<long>, hits array<int>"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId() << 32
    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    for batch in batches:
        ids = batch.column(0)
        for low, high, data, bounds in W.slabs(batch.column(1), SEGMENT_BYTES):
            h, first = W.hashed(data, bounds, W.ALNUM)
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            new = np.flatnonzero(np.r_[True, sorted_h[1:] != sorted_h[:-1]]) if len(h) else np.zeros(0, np.int64)
            gaps = np.diff(order, prepend=0)
            gaps[new] = order[new]
            lengths = np.diff(np.r_[new, len(h)])
            one = [pa.array([segment], pa.int64())]
            one += [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (
                ids.slice(low, high - low).cast(pa.int64()), pa.array(np.diff(first), pa.int64()),
                pa.array(sorted_h[new].view(np.int64), pa.int64()), pa.array(lengths, pa.int32()), pa.array(gaps, pa.int32()))]
            yield pa.RecordBatch.from_arrays(one, names)
            segment += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index of all words of ``text_col``; ``id_col`` is a number."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), W.utf8(text_col).alias("body"))
    return materialize(rows.mapInArrow(_index, INDEX_SCHEMA), "postings")


def windows_of(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of all phrases one after the other, their lengths, item ids, whether there is an id)."""
    hashes = W.hash_texts([t or "" for _, t in items], W.ALNUM)
    terms, sizes, ids = [], [], []
    for (item, _), h in zip(items, hashes):
        if not len(h):
            continue
        size = min(window, len(h))
        phrases = np.unique(np.lib.stride_tricks.sliding_window_view(h, size), axis=0)
        terms.append(phrases.ravel())
        sizes += [size] * len(phrases)
        ids += [item] * len(phrases)
    flat = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
    return flat, np.array(sizes, np.int64), np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], bool)


def _phrases(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms as a table of one phrase a row, padded, and which cells are words."""
    width = int(sizes.max())
    inside = np.arange(width) < sizes[:, None]
    table = np.zeros((len(sizes), width), np.uint64)
    table[inside] = flat
    return table, inside


def find(terms: np.ndarray, lengths: np.ndarray, gaps: np.ndarray, firsts: np.ndarray,
         table: np.ndarray, inside: np.ndarray, sizes: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start position, document) of all matches in one segment."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    running = np.cumsum(gaps)
    positions = running - np.repeat(running[begins] - gaps[begins], lengths)
    wanted, at = np.unique(table[inside], return_inverse=True)
    slot = np.searchsorted(terms.view(np.uint64), wanted)
    slot[slot == len(terms)] = 0
    known = terms.view(np.uint64)[slot] == wanted
    count = np.where(known, lengths[slot], 0)
    cell = np.zeros(table.shape, np.int64)
    cell[inside] = at
    rarity = np.where(inside, count[cell], np.iinfo(np.int64).max)
    alive = np.flatnonzero(rarity.min(axis=1) > 0)
    order = np.argsort(rarity[alive], axis=1, kind="stable")
    # one ascending list of (term, position) over the wanted terms: a place is looked up by bisection
    span = int(firsts[-1]) + 1
    which = np.flatnonzero(known)
    lists = np.concatenate([positions[begins[s]:ends[s]] for s in slot[which]]) if len(which) else np.zeros(0, np.int64)
    keys = np.repeat(which, count[which]) * span + lists
    key_begin = np.zeros(len(wanted), np.int64)
    key_begin[which] = np.cumsum(count[which]) - count[which]
    found = [(np.zeros(0, np.int64),) * 3]
    rare = cell[alive, order[:, 0]] if len(alive) else np.zeros(0, np.int64)
    load = np.cumsum(count[rare])
    low = 0
    while low < len(alive):
        high = max(low + 1, int(np.searchsorted(load, (load[low - 1] if low else 0) + STEP, "right")))
        n = count[rare[low:high]]
        phrase = np.repeat(np.arange(low, high), n)
        inner = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
        anchor = lists[np.repeat(key_begin[rare[low:high]], n) + inner]
        doc = np.searchsorted(firsts, anchor, "right") - 1
        start = anchor - order[phrase, 0]
        # a phrase may overhang its document by the slop only
        fits = (start + slop >= firsts[doc]) & (start + sizes[alive[phrase]] <= firsts[doc + 1] + slop)
        phrase, start, doc = phrase[fits], start[fits], doc[fits]
        for step in range(1, table.shape[1]):
            word = order[phrase, step]
            real = word < sizes[alive[phrase]]
            first_place = np.maximum(start + word - slop, firsts[doc])
            last_place = np.minimum(start + word + slop, firsts[doc + 1] - 1)
            base = cell[alive[phrase], word] * span
            place = np.searchsorted(keys, base + first_place)
            hit = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] <= base + last_place)
            phrase, start, doc = (x[hit | ~real] for x in (phrase, start, doc))
        found.append((alive[phrase], start, doc))
        low = high
    phrase, start, doc = (np.concatenate(x) for x in zip(*found))
    return phrase, start, doc


def _search(block, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, sizes, ids, named = block.value
        table, inside = _phrases(flat, sizes)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes_in, terms, lengths, gaps = (W.list_of(batch.column(k), row).astype(np.int64) for k in range(1, 5))
                firsts = np.r_[0, np.cumsum(sizes_in)]
                if not len(terms):
                    continue
                phrase, start, doc = find(terms, lengths, gaps, firsts, table, inside, sizes, slop)
                if not len(phrase):
                    continue
                change = np.zeros(int(firsts[-1]) + 1, np.int64)
                np.add.at(change, np.maximum(start, firsts[doc]), 1)
                np.add.at(change, np.minimum(start + sizes[phrase], firsts[doc + 1]), -1)
                hits = np.flatnonzero(np.cumsum(change) > 0)
                doc_of_hit = np.searchsorted(firsts, hits, "right") - 1
                places = np.unique(doc)
                good = named[phrase]
                pairs = np.unique(np.stack([doc[good], ids[phrase[good]]]), axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(places), batch.column(0)[row].as_py()), pa.int64()), pa.array(places, pa.int32()),
                    W.lists(pairs[1], np.searchsorted(pairs[0], np.r_[places, len(firsts)]), pa.int64()),
                    W.lists(hits - firsts[doc_of_hit], np.searchsorted(doc_of_hit, np.r_[places, len(firsts)]), pa.int32()),
                ], ["segment", "place", "item_ids", "hits"])
    return run


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int | None, str | None]]]:
    block, words = [], 0
    for row in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        size = len(row[1] or "") // 2 + 1  # a bound of its words
        if block and words + size > block_words:
            yield block
            block, words = [], 0
        block.append((row[0], row[1]))
        words += size
    if block:
        yield block


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
           slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents of the index with matches: (segment, place, item_ids, hits), hits being word numbers in the document."""
    spark = index.sparkSession
    path = scratch_path(spark, "hits")
    spark.createDataFrame([], HITS_SCHEMA).write.parquet(path)
    lists_only = index.select("segment", "doc_words", "terms", "lengths", "gaps")
    for block in _blocks(items, id_col, text_col, block_words):
        phrases = windows_of(block, window)
        if len(phrases[1]):
            held = spark.sparkContext.broadcast(phrases)
            lists_only.mapInArrow(_search(held, slop), HITS_SCHEMA).write.mode("append").parquet(path)
            held.unpersist()
    return (spark.read.schema(HITS_SCHEMA).parquet(path).groupBy("segment", "place")
            .agg(F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits")))


def contaminated_words(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                       slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: id, n_words, item_ids (of matching items), hits (numbers of its words inside a match)."""
    index = build_index(docs, id_col, text_col)
    hits = search(index, items, window=window, slop=slop, block_words=block_words)
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("place", "doc")).select(
        "segment", "place", F.col("doc.doc_ids").alias(id_col), F.col("doc.doc_words").alias("n_words"))
    return rows.join(hits, ["segment", "place"], "left").select(
        id_col, "n_words", F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"))
