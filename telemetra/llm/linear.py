"""Hashed text features and linear models on them.

A text is a vector of three blocks: buckets of words and pairs of neighbouring
words, buckets of runs of four bytes, and a few bins of its repetition.  The
first two hold log(1 + count), scaled to length one.  Models are fitted in one
task on the features of a bounded sample of rows; scoring runs in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum

BLOCK = 2048
BINS = 16
N_FEATURES = 2 * BLOCK + 2 * BINS
_SHIFT = np.uint64(64 - BLOCK.bit_length() + 1)


def _block(bucket: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    counts = np.bincount(doc * BLOCK + bucket, minlength=n * BLOCK).reshape(n, BLOCK)
    out = np.log1p(counts.astype(np.float32))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def _bins(share: np.ndarray) -> np.ndarray:
    return np.eye(BINS, dtype=np.float32)[np.minimum(BINS - 1, (share * BINS).astype(int))]


def repetition(w: textnum.Words, same: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Bins of the share of words equal to the word before, and of the share
    of pairs of neighbours that occurred before in the text."""
    n = len(w.offsets) - 1
    pairs = np.maximum(np.bincount(doc[:-1][same], minlength=n), 1) if len(doc) > 1 else np.ones(n)
    if len(doc) < 2:
        return np.hstack([_bins(np.zeros(n))] * 2)
    equal = (w.hash[:-1] == w.hash[1:]) & same
    stutter = np.bincount(doc[:-1][equal], minlength=n) / pairs
    pair, owner = textnum.windows(w.hash, 2)[same], doc[:-1][same]
    order = np.lexsort((pair, owner))
    again = (pair[order][1:] == pair[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.hstack([_bins(stutter), _bins(np.bincount(owner[order][1:][again], minlength=n) / pairs)])


def features(chunk: textnum.Chunk) -> np.ndarray:
    """(documents, N_FEATURES) float32; of an empty text only the lowest bins are set."""
    w = textnum.words(chunk)
    doc = textnum.documents_of(w.offsets)
    pairs = textnum.windows(w.hash, 2)
    same = doc[:-1] == doc[1:] if len(doc) > 1 else np.zeros(0, bool)
    terms = np.concatenate([w.hash, pairs[same]]) >> _SHIFT
    where = np.concatenate([doc, doc[: len(pairs)][same]])
    data = chunk.data.astype(np.uint64)
    grams = np.zeros(max(0, len(data) - 3), np.uint64)
    for j in range(4):
        grams = (grams << np.uint64(8)) | data[j : j + len(grams)]
    owner = np.repeat(np.arange(chunk.n), np.diff(chunk.offsets))
    inside = owner[: len(grams)] == owner[3:] if len(grams) else np.zeros(0, bool)
    grams = textnum.mix(grams[inside]) >> _SHIFT
    return np.hstack([_block(terms.astype(np.int64), where, chunk.n), _block(grams.astype(np.int64), owner[: len(inside)][inside], chunk.n), repetition(w, same, doc)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Model:
    """score = sigmoid(slope * (weights . features + bias) + shift)"""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.astype(x.dtype) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.shift)


#: What is returned without anything to learn from: 0.5 for every text.
UNDECIDED = Model(np.zeros(N_FEATURES, np.float32), 0.0)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for c in textnum.chunks(texts):
        out[c.first : c.first + c.n] = model.score(features(c).astype(np.float64))
    return out


def score_column(model: Model, text: Column) -> Column:
    """The model's score of a text column, in Arrow batches."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(scores(model, texts))

    return scored(text)


def learn(docs: DataFrame, chosen: DataFrame, train: Callable[[np.ndarray, np.ndarray], Model]) -> Model:
    """``train(features as float16, labels)`` of the rows of ``docs`` whose
    doc_id is in ``chosen`` (doc_id, label: distinct ids and whole numbers).

    ``chosen`` is bounded and broadcast, so no text moves before its features
    are computed.  The features (sparse, at most one row per chosen id, in the
    order of the ids) meet in one task, which trains; only the weights come to
    the driver.  A lost executor trains again, to the same model.
    """

    def rows(batches):
        for b in batches:
            for c in textnum.chunks(b.column(2)):
                packed = [np.flatnonzero(r).astype(np.uint16).tobytes() + r[r != 0].tobytes() for r in features(c).astype(np.float16)]
                part = [b.column(k).slice(c.first, c.n) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*part, pa.array(packed, pa.binary())], names=["doc_id", "label", "x"])

    def trained(got: pa.Table) -> pa.Table:
        got = got.sort_by("doc_id")
        x = np.zeros((got.num_rows, N_FEATURES), np.float16)
        for k, row in enumerate(got["x"]):  # places of the features that are not zero, then their values
            raw = row.as_buffer()
            half = raw.size // 2
            x[k, np.frombuffer(raw, np.uint16, half // 2)] = np.frombuffer(raw, np.float16, half // 2, half)
        m = train(x, got["label"].to_numpy())
        return pa.table({"weights": pa.array([m.weights.astype(np.float64).tobytes()], pa.binary()), "bias": [float(m.bias)], "slope": [float(m.slope)], "shift": [float(m.shift)]})

    labelled = F.broadcast(chosen.select("doc_id", F.col("label").cast("long").alias("label")))
    found = docs.select("doc_id", "text").join(labelled, "doc_id").select("doc_id", "label", "text").mapInArrow(rows, "doc_id long, label long, x binary")
    sample = found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    models = sample.groupBy().applyInArrow(trained, "weights binary, bias double, slope double, shift double").collect()
    return Model(np.frombuffer(models[0].weights, np.float64), models[0].bias, models[0].slope, models[0].shift) if models else UNDECIDED


def adam(gradient: Callable[[np.ndarray, float], tuple[np.ndarray, float]], steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Minimise from zero with full-batch gradients of (weights, bias)."""
    p = np.zeros(N_FEATURES + 1)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        gw, gb = gradient(p[:-1], p[-1])
        g = np.append(gw, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:-1], float(p[-1])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 200, rate: float = 0.2) -> Model:
    """L2-penalised logistic regression."""
    x32 = np.asarray(x, np.float32)

    def gradient(w, b):
        e = (sigmoid(x32 @ w.astype(np.float32) + np.float32(b)) - y).astype(np.float32) / len(y)
        return x32.T @ e + penalty * w, float(e.sum())

    w, b = adam(gradient, steps, rate)
    return Model(w, b)


def calibrate(model: Model, x: np.ndarray, y: np.ndarray, steps: int = 100) -> Model:
    """Platt scaling: a logistic regression of the label on the margin, with
    the smoothed targets (n + 1) / (n + 2), by Newton's method."""
    if not len(y):
        return model
    f = model.margin(x).astype(np.float64)
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([f, np.ones_like(f)], axis=1)
    p = np.array([1.0, 0.0])
    for _ in range(steps):
        q = sigmoid(z @ p)
        h = (z * (q * (1 - q))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (q - t))
        p -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return Model(model.weights, model.bias, float(max(p[0], 1e-6)), float(p[1]))
