"""Language identification as inference in a mixture of languages.

Each language is a distribution over hashed byte trigrams of letters, counted over all labelled rows. A document is a
mixture: expectation-maximisation estimates the share of each language from its trigrams. Languages are then taken in
order of their share; sets of growing size are fitted again until the penalised likelihood falls, and the best set is
selected. The largest share in it names the language.

A model holds the likelihood ratio of each trigram in each language, so it grows with the languages; a document is the
list of its distinct trigrams with their counts, and a batch is fitted in blocks of whole documents.

Defined results: a text that is null or has no letter gives ``und`` with score 0; without labelled rows every text is
``und``; a null id is neither held out nor learned from; repeated rows each get a row; without rows there are none.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm import words as W

UNKNOWN = "und"
FEATURES = 1 << 15
SMOOTHING = 0.5
#: sets up to this size are tried in any case, larger ones while the penalised likelihood grows
TRIED_SET = 3
ROUNDS = 12
#: likelihood ratios held at once
BLOCK = 1 << 20
#: weight of the penalty; above 1 because overlapping trigrams repeat their evidence
PENALTY = 3.0

_LETTERS = W._table(lambda c: 97 <= c <= 122 or c >= 128)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram, its text) of all texts of a slab; a run of other characters is one blank, ends are blanks."""
    body = _LETTERS[data]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.zeros(len(body), bool)
    first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    letter = body != W.BLANK
    opens = letter & np.r_[True, ~letter[:-1]] if len(letter) else letter
    opens |= letter & first  # a text begins with a blank before its first letter
    at = np.flatnonzero(letter)
    here, doc = body[at].astype(np.int64), doc[at]
    starts = opens[at]
    ends = np.r_[starts[1:], True] if len(at) else starts
    before = np.where(starts, W.BLANK, np.r_[W.BLANK, here[:-1]] if len(at) else here)
    after = np.where(ends, W.BLANK, np.r_[here[1:], W.BLANK] if len(at) else here)
    h = (before * 0x9E3779B1 + here * 0x85EBCA77 + after * 0xC2B2AE3D) & 0xFFFFFFFF
    return ((h ^ (h >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - FEATURES.bit_length() + 1), doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for low, high, data, bounds in W.slabs(batch.column(1)):
            gram, doc = trigrams(data, bounds)
            names = sorted(set(langs[low:high]))
            code = np.array([names.index(x) for x in langs[low:high]], np.int64)
            table = np.bincount(code[doc] * FEATURES + gram, minlength=len(names) * FEATURES).reshape(len(names), FEATURES)
            for name, row in zip(names, table):
                seen[name] = seen[name] + row if name in seen else row
    for name, row in seen.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())],
                                         ["lang", "gram", "n"])


class Counts:
    """Distinct trigrams of documents, in order of the document, with their counts."""

    def __init__(self, doc: np.ndarray, gram: np.ndarray, n: np.ndarray, docs: int):
        self.doc, self.gram, self.n, self.docs = doc, gram, n.astype(np.float32), docs
        self.first = np.searchsorted(doc, np.arange(docs + 1))
        self.total = np.bincount(doc, n, minlength=docs)

    @classmethod
    def of(cls, gram: np.ndarray, doc: np.ndarray, docs: int) -> Counts:
        key, n = np.unique(doc * FEATURES + gram, return_counts=True)
        return cls(key // FEATURES, key % FEATURES, n, docs)

    @classmethod
    def dense(cls, table: np.ndarray) -> Counts:
        doc, gram = np.nonzero(table)
        return cls(doc, gram, table[doc, gram], len(table))

    def some(self, picked: np.ndarray) -> Counts:
        """Of the documents marked."""
        own = picked[self.doc]
        return Counts((np.cumsum(picked) - 1)[self.doc[own]], self.gram[own], self.n[own], int(picked.sum()))

    def blocks(self, size: int) -> Iterator[tuple[int, int, Counts]]:
        """(first document, end, their counts) of runs of about ``size`` trigrams; one longer document is its own run."""
        low = 0
        while low < self.docs:
            high = max(low + 1, int(np.searchsorted(self.first, self.first[low] + size, "right")) - 1)
            a, b = self.first[low], self.first[high]
            yield low, high, Counts(self.doc[a:b] - low, self.gram[a:b], self.n[a:b], high - low)
            low = high

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document, along the last axis."""
        out = np.zeros((*values.shape[:-1], self.docs))
        there = np.flatnonzero(np.diff(self.first))
        if len(there):
            out[..., there] = np.add.reduceat(values, self.first[there], axis=-1)
        return out


class Model:
    """Languages, the likelihood ratio of each trigram in each language to the mean of all, and that of the mean to chance."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
        mean = p.mean(axis=0)
        self.ratio = (p / mean).T.astype(np.float32)
        self.usual = np.log(mean * counts.shape[1])

    def fit(self, counts: Counts | np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """(shares, log-likelihood) of the documents over the languages allowed for each."""
        if not isinstance(counts, Counts):
            counts = Counts.dense(counts)
        ratio, size = self.ratio.T[:, counts.gram], np.diff(counts.first)
        share = allowed / allowed.sum(axis=1, keepdims=True)

        def likelihood():
            return np.maximum((np.repeat(share.T.astype(np.float32), size, axis=1) * ratio).sum(axis=0), 1e-30)

        for _ in range(rounds):
            share = share * counts.sums(counts.n / likelihood() * ratio).T
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-30)
        return share, counts.sums(counts.n * np.log(likelihood().astype(float)))

    def _predict(self, counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        penalty = PENALTY * 0.5 * np.log(np.maximum(counts.total, 2))
        full, _ = self.fit(counts, np.ones((counts.docs, len(self.langs))), ROUNDS)
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
        single = counts.sums(counts.n * np.log(self.ratio.T[:, counts.gram])).T
        best = np.zeros_like(full)
        best[np.arange(len(full)), single.argmax(axis=1)] = 1
        fitted = single.max(axis=1)
        top = fitted - penalty
        grows = np.ones(counts.docs, bool)
        for size in range(2, len(self.langs) + 1):
            at = np.flatnonzero(grows)
            if not len(at):
                break
            share, fit = self.fit(counts.some(grows), (rank[at] < size).astype(float), ROUNDS // 2)
            less = fit - size * penalty[at]
            better = less > top[at]
            best[at[better]], top[at[better]], fitted[at[better]] = share[better], less[better], fit[better]
            if size >= TRIED_SET:
                grows[at[~better]] = False
        best /= best.sum(axis=1, keepdims=True)
        return best.argmax(axis=1), best.max(axis=1), (fitted + counts.sums(counts.n * self.usual[counts.gram])) / np.maximum(counts.total, 1)

    def predict(self, counts: Counts | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, its share, log-likelihood ratio to chance of a trigram) of documents."""
        if not isinstance(counts, Counts):
            counts = Counts.dense(counts)
        found = [self._predict(block) for _, _, block in counts.blocks(BLOCK // len(self.langs))]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0), np.zeros(0))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of all rows of ``docs`` that have a language."""
    read = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), W.utf8(text_col).alias("body"))
    counts = read.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    wide = counts.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("grams"))
    rows = {}
    for row in wide.toLocalIterator():  # FEATURES counts at most for each language
        rows[row.lang] = np.zeros(FEATURES)
        for gram, n in row.grams:
            rows[row.lang][gram] = n
    langs = sorted(rows)
    return Model(langs, np.stack([rows[x] for x in langs])) if langs else None


def _has_letter(body: bytes) -> bool:
    return any(c.isalpha() for c in body.decode("utf-8", "replace"))


def _predict(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for low, high, data, bounds in W.slabs(batch.column(1)):
                names, scores, sense = [UNKNOWN] * (high - low), np.zeros(high - low), np.zeros(high - low)
                if model is not None:
                    gram, doc = trigrams(data, bounds)
                    best, share, sense = model.predict(Counts.of(gram, doc, high - low))
                    ascii_letters = np.zeros(len(data) + 1, np.int64)
                    np.cumsum((_LETTERS[data] != W.BLANK) & (data < 128), out=ascii_letters[1:])
                    plain = ascii_letters[bounds[1:]] > ascii_letters[bounds[:-1]]
                    for k in range(high - low):
                        if plain[k] or _has_letter(data[bounds[k]:bounds[k + 1]].tobytes()):
                            names[k], scores[k] = model.langs[best[k]], min(1.0, float(share[k]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(names, pa.string()), pa.array(scores),
                                                  pa.array(sense)], ["id", "lang_pred", "score", "sense"])
    return run


def judged(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, sense) of every row. ``sense`` is the mean log-likelihood ratio of a trigram in the selected
    languages to one drawn by chance: a text below 0 is likelier to be gibberish than to be of any of them."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).alias("id"), W.utf8(text_col).alias("body")).mapInArrow(
        _predict(held), W.schema(("id", docs.schema[id_col].dataType), ("lang_pred", "string"), ("score", "double"), ("sense", "double"))
    ).withColumnRenamed("id", id_col)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    return judged(docs, model, id_col, text_col).drop("sense")


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", key_col: str | None = None) -> DataFrame:
    """(id, held_out, lang_pred, score): the model is learned from the rows not held out by ``key_col`` (the id)."""
    key = F.col(key_col or id_col)
    model = learn(docs.where(key.isNotNull() & ~held_out(key)), text_col, lang_col)
    found = identify(docs, model, id_col, text_col)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")


assert math.log2(FEATURES).is_integer()
