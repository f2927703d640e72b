"""Quality rules: counted limits first, then a calibrated classifier.

The classifier is a logistic regression on hashed word and character n-grams
of rows labelled for quality, with Platt scaling on rows it has not seen,
scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear, textnum

N_LABELLED = 4000
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def _per_document(chunk: textnum.Chunk, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[chunk.offsets[1:]] - total[chunk.offsets[:-1]]


def _seen(hash: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: how often its hash occurs in its document; is it the first there."""
    order = np.lexsort((hash, doc))
    h, d = hash[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    group = np.cumsum(first) - 1
    size = np.bincount(group) if len(h) else np.zeros(0, np.int64)
    times, is_first = np.empty(len(h), np.int64), np.empty(len(h), bool)
    times[order], is_first[order] = size[group], first
    return times, is_first


def count(chunk: textnum.Chunk) -> np.ndarray:
    """(documents, 5) of COUNTS."""
    data, n = chunk.data, chunk.n
    inside = textnum.NOT_SPACE[data]
    w = textnum.words(chunk)
    out = np.zeros((n, len(COUNTS)), np.int64)
    out[:, 0] = np.diff(w.offsets)
    out[:, 1] = _per_document(chunk, inside & ((data & 0xC0) != 0x80))
    out[:, 2] = _per_document(chunk, _IS_SYMBOL[data])

    starts, ends = textnum.pieces(chunk, data != 10)
    owner = np.searchsorted(chunk.offsets, starts, side="right") - 1
    worded = np.concatenate([[0], np.cumsum(inside)])
    has_word = worded[ends] > worded[starts]
    _, first = _seen(textnum.hashes(data, starts, ends)[has_word], owner[has_word])
    out[:, 3] = np.bincount(owner[has_word][~first], minlength=n)

    runs, doc = textnum.windows(w.hash, WINDOW), textnum.documents_of(w.offsets)
    whole = np.flatnonzero(doc[: len(runs)] == doc[WINDOW - 1 :]) if len(runs) else np.zeros(0, np.int64)
    times, _ = _seen(runs[whole], doc[whole])
    again = whole[times >= 2]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    out[:, 4] = np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=n)
    return out


def train(x: np.ndarray, quality: np.ndarray) -> linear.Model:
    """A logistic regression on three quarters of the rows, calibrated on the rest."""
    y = quality.astype(float)
    kept_back = np.arange(len(y)) % 4 == 3
    if len(set(y[~kept_back])) < 2:
        return linear.UNDECIDED
    return linear.calibrate(linear.logistic(x[~kept_back], y[~kept_back]), x[kept_back].astype(np.float32), y[kept_back])


def fit(docs: DataFrame, labels: DataFrame, n_labelled: int = N_LABELLED) -> linear.Model:
    """Learn from at most ``n_labelled`` labelled rows, chosen by the hash of
    their doc_id; every fourth is kept back to calibrate the probabilities.

    A doc_id labelled both ways is left out.  Without both labels nothing can
    be learnt: every probability is 0.5 and the rules alone decide.
    """
    marked = labels.dropna(subset=["doc_id", "quality"]).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    chosen = marked.orderBy(F.xxhash64("doc_id", F.lit(10))).limit(n_labelled).select("doc_id", F.col("quality").alias("label"))
    return linear.learn(docs, chosen, train)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, least_words: int = 10, most_repeat: int = 20, **sample) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, any other columns) with the counts
    of its whole text, ``base_failed`` (fewer than ``least_words`` words, or
    more than ``most_repeat`` % of them in repeated windows), ``score`` (the
    probability of a good document) and ``kept`` (not failed and score >=
    threshold).  Existing columns of these names are replaced.

    A NULL text counts as empty: all counts 0, failed, not kept.
    """
    names = (*COUNTS, "base_failed", "score", "kept")
    rows = docs.drop(*names, "_q")
    model = fit(rows.select("doc_id", "text"), labels, **sample)

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", score: double>")
    def judged(texts: pa.Array) -> pa.Array:
        counts, score = np.zeros((len(texts), len(COUNTS)), np.int64), np.zeros(len(texts))
        for c in textnum.chunks(texts):
            at = slice(c.first, c.first + c.n)
            counts[at], score[at] = count(c), model.score(linear.features(c).astype(np.float64))
        return pa.StructArray.from_arrays([*(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(score)], names=[*COUNTS, "score"])

    out = rows.withColumn("_q", judged(F.col("text")))
    out = out.select(*rows.columns, *[F.col(f"_q.{c}") for c in (*COUNTS, "score")])
    out = out.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
