"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, scores as sparse dot products.

A text's words are cut where letters and other characters meet, so marks at words are words too. Words and pairs of neighbours are
hashed into ``buckets``, a word beside itself as one pair whatever the word; a feature's value is its share of all n-grams of the text, times ``scale``. So texts of any length compare and no
text is cut.

The model is fitted on at most ``most`` labelled rows, the first by a hash of their doc_id, one for each id; that is a sample whose size doesn't grow with
the table, so its ids can be broadcast. Each row comes ``epochs`` times, in an order drawn by hash, to the one task that fits; what
it holds is the weights. Scoring reads every row, and takes the weights (4 bytes a bucket) by broadcast.

Defined cases: a null or empty text scores by the bias alone. Labels that are null don't count; of several labels for one id the largest
does. Without labels the score is 1/2. Repeated rows get equal scores. Other columns than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._words import SPACES, Words, chunks, flat, mix, tidy
from glyphmill.llm._work import small_batches


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    most: int = 6000
    epochs: int = 3
    scale: float = 100.0
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01


_MARK = np.zeros(256, bool)
_MARK[33:128] = True
_MARK[48:58] = _MARK[65:91] = _MARK[97:123] = False


class _Runs(Words):
    """Words that also end where marks and other characters meet."""

    def __init__(self, column: pa.Array):
        buf, at = flat(column)
        self.buf, self.rows = buf, len(at) - 1
        kind = np.where(SPACES[buf], np.uint8(0), np.where(_MARK[buf], np.uint8(2), np.uint8(1)))
        edge = np.zeros(len(buf) + 1, bool)
        edge[at] = True
        turn = edge.copy()
        turn[1:-1] |= kind[1:] != kind[:-1]
        where = np.flatnonzero(turn)
        begin, end = where[:-1], where[1:]
        real = kind[begin] > 0 if len(begin) else np.zeros(0, bool)
        self.start, self.end = begin[real], end[real]
        self.first = np.searchsorted(self.start, at)
        self.hash = self._hashes()


def features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of each row, and where each row's begin with the end."""
    words = _Runs(column)
    one = (words.hash % np.uint64(buckets)).astype(np.int64)
    n, last = len(one), np.repeat(words.first[1:], words.counts())
    pair = np.flatnonzero(np.arange(n) + 1 < last)
    left, right = words.hash[pair], words.hash[pair + 1]
    two = (np.where(left == right, mix(np.uint64([1])), mix(left * np.uint64(0x9E3779B97F4A7C15) + right)) % np.uint64(buckets)).astype(np.int64)
    both = np.empty(n + len(two), np.int64)
    at = np.arange(n) + np.searchsorted(pair, np.arange(n))
    both[at] = one
    free = np.ones(len(both), bool)
    free[at] = False
    both[free] = two
    first = np.r_[at, len(both)][np.minimum(words.first, n)] if n else np.zeros(words.rows + 1, np.int64)
    return both, first


class Learner:
    """FTRL-Proximal for logistic loss. The last weight is the bias, without penalty."""

    def __init__(self, s: Settings):
        self.s = s
        self.z, self.n = np.zeros(s.buckets + 1), np.zeros(s.buckets + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        s, z = self.s, self.z[at]
        l1 = np.full(len(z), s.l1)
        l1[-1] = 0
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """at ends with the bias."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _examples(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 2 << 20):
            at, first = features(batch.column("text"), s.buckets)
            kinds, shares = [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                k, c = np.unique(at[a:b], return_counts=True)
                kinds.append(k.astype(np.int32).tobytes())
                shares.append((s.scale * c / max(1, b - a)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(kinds, pa.binary()), pa.array(shares, pa.binary())], names=["doc_id", "quality", "kinds", "shares"])

    return tidy(run)


def _fit(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, seen = Learner(s), 0
        for batch in batches:
            for label, k, x in zip(*(batch.column(c).to_pylist() for c in ("quality", "kinds", "shares")), strict=True):
                learner.learn(np.r_[np.frombuffer(k, np.int32), s.buckets], np.r_[np.frombuffer(x, np.float32).astype(float), 1.0], int(label))
                seen += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([learner.weights(slice(None)).astype(np.float32).tobytes()], pa.binary())], names=["weights"])

    return tidy(run)


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """The weights, the bias last."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(s.most)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    # Of rows with one id one is learned from, so the bound holds for rows too.
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "quality")
    made = rows.mapInArrow(_examples(s), "doc_id long, quality int, kinds binary, shares binary")
    epochs = made.select("*", F.explode(F.sequence(F.lit(1), F.lit(s.epochs))).alias("epoch"))
    ordered = epochs.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "doc_id"), "doc_id", "kinds")
    got = ordered.mapInArrow(_fit(s), "weights binary").collect()
    return np.frombuffer(got[0]["weights"], np.float32) if got else np.zeros(s.buckets + 1, np.float32)


def _score(model, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value.astype(np.float64)
        for batch in chunks(batches, "text", 4 << 20):
            at, first = features(batch.column("text"), s.buckets)
            total = np.r_[0.0, np.cumsum(weights[at])] if len(first) == 2 else None
            if total is None:
                sums = np.add.reduceat(np.r_[weights[at], 0.0], np.minimum(first[:-1], len(at)))
                sums[first[:-1] == first[1:]] = 0.0
            else:
                sums = total[-1:] - total[:1]
            x = s.scale * sums / np.maximum(1, np.diff(first)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(x, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])

    return tidy(run)


def score(docs: DataFrame, weights: np.ndarray, s: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(_score(model, s), f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    small_batches(docs.sparkSession)
    return score(docs, fit(docs, labels, s), s)
