"""Language-model scores of documents by masked pseudo-likelihood.

A network with one hidden layer predicts each word from the words on both sides of it. Words are hashed to buckets, by
ending and by spelling; the most frequent buckets are classes of their own, the others share the class of their ending.
The network predicts the class from the classes around; the corpus counts give the word within its class:

    p(word | both sides) = softmax(output . tanh(sum of the neighbours' vectors))[class] * count(word) / count(class)

Counts and training cover every word of the corpus: each partition trains on all words of its documents, starting from the
same weights, and weights are averaged by the number of words, for ``EPOCHS`` rounds. A document's
score is the sum of the conditional log-probabilities of all its words, and their mean.

Defined results: a text that is null or without words has 0 tokens, sum 0 and a null mean; words beyond the ends of a
text are a boundary class; repeated rows each get a row; without rows there are none.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm import words as W

SIDE = 3
HIDDEN = 16
CLASSES = 128
ENDINGS = 64
SPELLINGS = 4096
BUCKETS = ENDINGS * SPELLINGS
BOUNDARY = CLASSES - 1
FREQUENT = CLASSES - 1 - ENDINGS
EPOCHS = 2
BATCH = 512
RATE = 0.15
LIMIT = 1.5
SMOOTHING = 0.5
STEP = 4096
PLACES = np.arange(2 * SIDE)[:, None] * CLASSES
SHAPES = ((2 * SIDE, CLASSES, HIDDEN), (CLASSES, HIDDEN), (CLASSES,))


def buckets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, number of each text's first word)."""
    body, starts, ends, first = W.split_words(data, bounds, W.ALNUM)
    h = W.hash_words(body, starts, ends)
    last = body[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, body[ends - 2], 0).astype(np.int64)
    return ((last * 31 + before * 17) % ENDINGS) * SPELLINGS + (h % np.uint64(SPELLINGS)).astype(np.int64), first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, bounds in W.slabs(batch.column(0)):
            total += np.bincount(buckets(data, bounds)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])


class Classes:
    """The class of every bucket and the log-probability of a bucket in its class."""

    def __init__(self, counts: np.ndarray):
        self.of = FREQUENT + np.arange(BUCKETS) // SPELLINGS
        top = np.lexsort((np.arange(BUCKETS), -counts))[:FREQUENT]
        self.of[top] = np.arange(FREQUENT)
        smooth = counts + SMOOTHING
        mass = np.bincount(self.of, smooth, minlength=CLASSES)
        self.within = np.log(smooth / mass[self.of])
        self.share = np.log((mass + 1) / (mass + 1).sum())


def start(classes: Classes) -> list[np.ndarray]:
    rng = np.random.default_rng(3)
    around, out, bias = (rng.normal(0, 0.1, shape).astype(np.float32) for shape in SHAPES)
    return [around, out, np.maximum(classes.share, -10).astype(np.float32)]


def neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word the classes of the ``SIDE`` words before and after it, in its text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    padded = np.full(len(own) + SIDE * len(first), BOUNDARY, np.int64)
    at = np.arange(len(own)) + SIDE * (doc + 1)
    padded[at] = own
    return np.stack([padded[at + j] for j in (*range(-SIDE, 0), *range(1, SIDE + 1))])


def hidden(weights: list[np.ndarray], context: np.ndarray) -> np.ndarray:
    total = weights[0][0].take(context[0], axis=0)
    for j in range(1, 2 * SIDE):
        total += weights[0][j].take(context[j], axis=0)
    return np.tanh(total)


def train(weights: list[np.ndarray], own: np.ndarray, context: np.ndarray, squares: list[np.ndarray]) -> None:
    """Adagrad steps over batches, in place."""
    for low in range(0, len(own), BATCH):
        target, near = own[low:low + BATCH], context[:, low:low + BATCH]
        h = hidden(weights, near)
        p = np.exp(h @ weights[1].T + weights[2])
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p /= len(target)
        back = (p @ weights[1]) * (1 - h * h)
        place, slopes = (near + PLACES).ravel(), np.tile(back.T.astype(float), 2 * SIDE)
        around = np.stack([np.bincount(place, x, 2 * SIDE * CLASSES) for x in slopes], axis=1).reshape(weights[0].shape).astype(np.float32)
        for w, square, slope in zip(weights, squares, (around, p.T @ h, p.sum(axis=0))):
            square += slope * slope
            w -= RATE * slope / np.sqrt(square + 1e-8)
        np.clip(weights[1], -LIMIT, LIMIT, out=weights[1])
        np.clip(weights[2], -10, 10, out=weights[2])


def _flat(weights: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights])


def _shaped(flat: np.ndarray) -> list[np.ndarray]:
    sizes = np.cumsum([int(np.prod(s)) for s in SHAPES])[:-1]
    return [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, sizes), SHAPES)]


def _train(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, given = held.value
        weights = [w.copy() for w in given]
        squares = [np.full(w.shape, 1e-3, np.float32) for w in weights]
        seen = 0
        for batch in batches:
            for _, _, data, bounds in W.slabs(batch.column(0)):
                bucket, first = buckets(data, bounds)
                own = classes.of[bucket]
                train(weights, own, neighbours(own, first), squares)
                seen += len(own)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([_flat(weights).tolist()], pa.list_(pa.float64()))], ["n", "weights"])
    return run


class Network:
    def __init__(self, classes: Classes, weights: list[np.ndarray]):
        self.classes, self.weights = classes, weights

    def log_probabilities(self, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each word, given the words on both sides."""
        own = self.classes.of[bucket]
        context = neighbours(own, first)
        out = self.classes.within[bucket]
        around, output, bias = self.weights
        for low in range(0, len(own), STEP):
            logits = hidden(self.weights, context[:, low:low + STEP]) @ output.T
            logits += bias
            out[low:low + STEP] += logits[np.arange(len(logits)), own[low:low + STEP]]
            np.exp(logits, out=logits)  # weights are bounded, so this can't overflow
            out[low:low + STEP] -= np.log(logits.sum(axis=1))
        return out


def learn(docs: DataFrame, text_col: str = "text") -> Network:
    """Counts words over all texts and trains on all of them."""
    context = docs.sparkSession.sparkContext
    bodies = docs.select(W.utf8(text_col).alias("body"))
    counted = bodies.mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS)
    counts[counted["bucket"].to_numpy(int)] = counted["n"].to_numpy(float)
    classes = Classes(counts)
    weights = start(classes)
    for _ in range(EPOCHS):
        held = context.broadcast((classes, weights))
        parts = bodies.mapInArrow(_train(held), "n long, weights array<double>")
        each = parts.select("n", F.posexplode("weights").alias("at", "w"))
        mean = each.groupBy("at").agg((F.sum(F.col("n") * F.col("w")) / F.sum("n")).alias("w")).toPandas()  # one row per weight
        if len(mean):
            weights = _shaped(mean.sort_values("at")["w"].to_numpy())
        held.unpersist()
    return Network(classes, weights)


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = held.value
        for batch in batches:
            for low, high, data, bounds in W.slabs(batch.column(1)):
                bucket, first = buckets(data, bounds)
                total = np.r_[0.0, np.cumsum(network.log_probabilities(bucket, first))]
                n = np.diff(first)
                added = total[first[1:]] - total[first[:-1]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(n, pa.int64()), pa.array(added),
                    pa.array(added / np.maximum(n, 1), mask=n == 0)], ["id", "n_tokens", "pll", "score"])
    return run


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, pll, score): words, their summed and mean conditional log-probability."""
    held = docs.sparkSession.sparkContext.broadcast(network)
    read = docs.select(F.col(id_col).alias("id"), W.utf8(text_col).alias("body"))
    kind = docs.schema[id_col].dataType.simpleString()
    return read.mapInArrow(_score(held), f"id {kind}, n_tokens long, pll double, score double").withColumnRenamed("id", id_col)
