"""Quality classifier with supervised subword embeddings.

A text is the mean of learned vectors: one per hashed word, per hashed pair of
neighbouring words and per hashed character n-gram inside a word (with its
white space neighbours).  A softmax over that mean gives the class.  Vectors
and output weights are trained together by numpy stochastic gradient descent.

Learning reads a bounded sample, ``SAMPLE`` labelled texts per class (those
with the smallest hash of the id); class totals over all labelled rows correct
the balanced sample to the real shares.  As the output is linear in the mean,
a trained model is one number per bucket, so scoring a corpus is a gather and
a sum per text, done on whole Arrow batches; every whole text is scored.

Defined results: null or empty text scores the prior; with no labelled row of
one class that prior is 0 or 1 smoothed by one row, with none at all 0.5;
labels other than 0 and 1 are ignored; repeated rows are scored each; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import SPACE, Words, gram_hash, pieces, text_buffer, text_parts
from lodestone.llm.common import filtered, narrow

BUCKETS = 1 << 16
DIM = 12
SAMPLE = 1500
EPOCHS = 5
RATE = 0.3
CHAR_GRAMS = (3, 4)
THRESHOLD = 0.3
#: Every text also has this many times one common feature (bucket 0), so short
#: texts lean on what short texts are like and an empty text is scored too.
COMMON = 40
#: A word that follows itself is one more feature (bucket 1), whatever the word.
REPEAT = 1
_MUL = np.uint32(0x9E3779B1)


def _characters(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, byte position) of the characters of valid UTF-8 bytes."""
    at = np.flatnonzero((part & 0xC0) != 0x80)
    value = part[at].astype(np.uint32)
    wide = np.flatnonzero(value >= 0xC0)
    if len(wide):
        p = at[wide]
        size = 2 + (part[p] >= 0xE0) + (part[p] >= 0xF0)
        for k in (1, 2, 3):
            m = size > k
            value[wide[m]] = value[wide[m]] * np.uint32(257) + part[np.minimum(p[m] + k, len(part) - 1)]
    return value, at


def bucket_stream(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) arrays of all features of a batch, in parts."""
    every = np.repeat(np.arange(len(offs) - 1), COMMON)
    yield every, np.zeros(len(every), dtype=np.int64)
    w = Words(buf, offs, fold_case=False, seed=11)
    doc = w.docs()
    shift = np.uint64(64 - 16)
    yield doc, (w.hash >> shift).astype(np.int64)
    if len(doc) > 1:
        pair = gram_hash(w.hash, 2)
        ok = doc[:-1] == doc[1:]
        same = doc[:-1][ok & (w.hash[:-1] == w.hash[1:])]
        yield same, np.full(len(same), REPEAT)
        yield doc[:-1][ok], (pair[ok] >> shift).astype(np.int64)
    for a, b in pieces(buf, offs):
        part = buf[a:b]
        value, at = _characters(part)
        blank = SPACE[part[at]]
        value = np.where(blank, np.uint32(32), value)
        owner = np.searchsorted(offs, at + a, side="right") - 1
        for n in CHAR_GRAMS:
            m = len(value) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint32)
            for k in range(n):
                h *= _MUL
                h += value[k:k + m]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            ok = owner[:m] == owner[n - 1:]
            for k in range(1, n - 1):
                ok &= ~blank[k:k + m]
            yield owner[:m][ok], (h[ok] >> np.uint32(16)).astype(np.int64)


@dataclass
class QualityModel:
    """``weight[bucket]`` is the class-1 log-odds a feature votes for; a text's
    log-odds are their mean plus ``offset``."""
    weight: np.ndarray
    offset: float


def sample_labels(labels: DataFrame, train: Column, size: int = SAMPLE) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Up to ``size`` (id, class) per class and the class totals."""
    rows = (narrow(labels.where(train), doc_id="doc_id", y="quality")
            .where("doc_id is not null and y in (0, 1)").withColumn("h", F.xxhash64("doc_id", F.lit(5))))
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picks = []
    for y in (0, 1):
        picks += [(r["doc_id"], y) for r in rows.where(F.col("y") == y).orderBy("h", "doc_id").limit(size).collect()]
    return picks, totals


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, buckets, weights): the distinct buckets of a text as int32 and
    their shares of its features as float32, both as bytes."""
    def run(batches):
        for b in batches:
            for i, j, part in text_parts(b.column(1)):
                keys = [d * BUCKETS + k for d, k in bucket_stream(*text_buffer(part))]
                u, c = np.unique(np.concatenate(keys), return_counts=True)
                cut = np.searchsorted(u, np.arange(j - i + 1) * BUCKETS)
                k = (u % BUCKETS).astype(np.int32)
                rows = [(k[s:e].tobytes(), (c[s:e] / max(c[s:e].sum(), 1)).astype(np.float32).tobytes())
                        for s, e in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([r[0] for r in rows], pa.binary()),
                                                  pa.array([r[1] for r in rows], pa.binary())],
                                                 names=["doc_id", "buckets", "weights"])
    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, buckets binary, weights binary")


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], totals: dict[int, int],
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 42) -> QualityModel:
    """Stochastic gradient descent over (buckets, shares, class), one example a
    step with a falling rate."""
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    prior = math.log((n1 + 0.5) / (n0 + 0.5))
    seen = [sum(1 for e in examples if e[2] == y) for y in (0, 1)]
    if not all(seen):
        return QualityModel(np.zeros(BUCKETS, np.float32), prior if n0 + n1 else 0.0)
    rng = np.random.default_rng(seed)
    vec = (rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    out = np.zeros((2, DIM), dtype=np.float32)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            k, share, y = examples[i]
            lr = rate * (1 - done / steps)
            done += 1
            mean = share @ vec[k]
            z = out @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = p @ out
            out -= lr * np.outer(p, mean)
            # normalised step: long and short texts move their mean equally far
            vec[k] -= (lr / float(share @ share) * share)[:, None] * g[None, :]
    d = out[1] - out[0]
    shift = prior - math.log(seen[1] / seen[0])  # the sample is balanced, the data are not
    return QualityModel((vec @ d).astype(np.float32), shift)


def learn(docs: DataFrame, labels: DataFrame, train_rows: Column, size: int = SAMPLE) -> QualityModel:
    """Fit on at most ``size`` labelled texts per class."""
    picks, totals = sample_labels(labels, train_rows, size)
    if not picks:
        return train([], totals)
    chosen = docs.sparkSession.createDataFrame(picks, "doc_id long, y int")  # at most 2 * size rows
    texts = narrow(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    got = {}
    for r in features(texts).collect():  # bounded by the sample
        got[r["doc_id"]] = (np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32))
    return train([(*got[d], y) for d, y in sorted(picks) if d in got], totals)


def batch_scores(weight: np.ndarray, offset: float, col) -> np.ndarray:
    """The probability of class 1 for every text of an Arrow column."""
    total, count = np.zeros(len(col)), np.zeros(len(col))
    for i, j, part in text_parts(col):
        for d, k in bucket_stream(*text_buffer(part)):
            total[i:j] += np.bincount(d, weights=weight[k], minlength=j - i)
            count[i:j] += np.bincount(d, minlength=j - i)
    z = total / np.maximum(count, 1) + offset
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.offset))  # BUCKETS numbers

    def run(batches):
        for b in batches:
            p = batch_scores(*shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])
    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows whose text scores at least ``threshold``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.offset))
    at = docs.columns.index(text)

    return filtered(docs, lambda b: batch_scores(*shared.value, b.column(at)) >= threshold)
