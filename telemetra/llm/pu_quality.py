"""Quality classifier learnt from positives and unlabelled text.

Trusted positives are documents labelled good; everything unlabelled is web
text of unknown quality.  The share of positives in it (the class prior) is
estimated first, then the non-negative unbiased risk is minimised:

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss, whose minimiser is the log-odds of a good document,
so its sigmoid is the score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear

N_POSITIVE, N_UNLABELLED = 2000, 4000
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 = 0; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def class_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in the unlabelled text, from out-of-fold scores.

    The text above any cut holds at least the positives' share above it, so
    every cut bounds the prior from above by (share of u) / (share of p).  The
    cut with the least upper confidence limit is taken, and of its share of u
    the lower confidence limit: too large a prior hides the negatives.
    """
    cuts = np.quantile(p, np.linspace(0, 0.99, 100))
    above = lambda s: 1 - np.searchsorted(np.sort(s), cuts, side="left") / len(s)
    qp, qu = above(p), above(u)
    slack = lambda s: np.sqrt(np.log(4 / delta) / (2 * len(s)))
    best = np.argmin((qu + slack(u) + slack(p)) / np.maximum(qp, 1e-9))
    return float(np.clip((qu[best] - slack(u)) / max(qp[best], 1e-9), 0.01, 0.99))


def nn_pu(p: np.ndarray, u: np.ndarray, prior: float, penalty: float = 1e-4, steps: int = 300, rate: float = 0.05) -> linear.Model:
    """Minimise the non-negative unbiased risk with the logistic loss."""

    def gradient(w, b):
        w32, b32 = w.astype(np.float32), np.float32(b)
        fp, fu = p @ w32 + b32, u @ w32 + b32
        sp, su = linear.sigmoid(fp), linear.sigmoid(fu)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        ep, eu = -prior * (1 - sp) / len(p), np.zeros_like(su)
        if negative >= 0:
            ep, eu = ep - prior * sp / len(p), su / len(u)
        else:  # the risk of the negatives fell below zero: step back until it is none
            ep, eu = prior * sp / len(p), -su / len(u)
        return p.T @ ep + u.T @ eu + penalty * w, float(ep.sum() + eu.sum())

    return linear.Model(*linear.adam(gradient, steps, rate))


def calibrate(model: linear.Model, p: np.ndarray, u: np.ndarray, prior: float) -> linear.Model:
    """Slope and shift of the margin with the least risk of the same kind on
    rows that the weights have not seen, searched on a grid."""
    fp, fu = model.margin(p).astype(np.float64), model.margin(u).astype(np.float64)
    best = (np.inf, 1.0, 0.0)
    for slope in np.exp(np.linspace(-2, 2, 41)):
        for shift in np.linspace(-12, 12, 121):
            gp, gu = slope * fp + shift, slope * fu + shift
            risk = prior * np.logaddexp(0, -gp).mean() + max(0.0, np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())
            best = min(best, (risk, float(slope), float(shift)))
    return linear.Model(model.weights, model.bias, best[1], best[2])


def train(x: np.ndarray, is_positive: np.ndarray) -> linear.Model:
    """Estimate the prior, minimise the risk on three quarters of the rows and
    calibrate on the rest; undecided with fewer than four rows of a kind."""
    # in an order of chance, so that slices, which copy nothing, are random parts
    chance = np.random.default_rng(4).permutation(len(x))
    good = is_positive[chance] == 1
    p, u = x[chance[good]].astype(np.float32), x[chance[~good]].astype(np.float32)
    if len(p) < 4 or len(u) < 4:
        return linear.UNDECIDED
    hp, hu = len(p) // 2, len(u) // 2
    first = linear.logistic(np.vstack([p[:hp], u[:hu]]), np.repeat([1.0, 0.0], [hp, hu]), steps=100)
    prior = class_prior(first.margin(p[hp:]), first.margin(u[hu:]))
    tp, tu = len(p) * 3 // 4, len(u) * 3 // 4
    return calibrate(nn_pu(p[:tp], u[:tu], prior), p[tp:], u[tu:], prior)


def fit(docs: DataFrame, labels: DataFrame, n_positive: int = N_POSITIVE, n_unlabelled: int = N_UNLABELLED) -> linear.Model:
    """Learn from at most ``n_positive`` rows labelled good and ``n_unlabelled``
    rows without a label, both outside the held-out fold and chosen by the
    hash of their doc_id.

    A doc_id that is labelled both ways is not trusted.  Without positives or
    without unlabelled rows nothing can be learnt: every score is 0.5.
    """
    chance = F.xxhash64("doc_id", F.lit(4))
    open_rows = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()
    marked = labels.filter(open_rows).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    positive = marked.filter("quality = 1").orderBy(chance).limit(n_positive)
    unlabelled = docs.filter(open_rows).select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti").distinct().orderBy(chance).limit(n_unlabelled)
    chosen = positive.select("doc_id", F.lit(1).alias("label")).union(unlabelled.select("doc_id", F.lit(0)))
    return linear.learn(docs, chosen, train)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **sample) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, any other columns) with
    ``held_out``, ``score`` (0 to 1, from the whole text alone) and
    ``predicted`` (1 if score >= threshold).  Existing columns of these names
    are replaced.

    A NULL text is scored as an empty one, which has no n-grams; equal
    texts have equal scores.  An empty table gives no rows.
    """
    kept = docs.drop("held_out", "score", "predicted")
    model = fit(kept.select("doc_id", "text"), labels, **sample)
    out = kept.withColumns({"held_out": held_out(F.col("doc_id")), "score": linear.score_column(model, F.col("text"))})
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
