"""What the learnt scores are made of, against plain Python and finite differences."""

import math

import numpy as np
import pyarrow as pa
import pytest

from telemetra.llm import linear, lm_score, pu_quality, quality_rules, textnum, url_filter, warc


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    p, u = np.zeros((40, linear.N_FEATURES), np.float32), np.zeros((60, linear.N_FEATURES), np.float32)
    p[:, :4], u[:, :4] = rng.normal(1, 1, (40, 4)), rng.normal(0, 1.5, (60, 4))
    return p, u


def _risk(p, u, w, b, prior):
    loss = lambda f: np.logaddexp(0, -f).mean()
    fp, fu = p @ w + b, u @ w + b
    negative = loss(-fu) - prior * loss(-fp)
    return prior * loss(fp), negative


def test_pu_risk_falls_and_its_gradient_is_the_risks(sample, monkeypatch):
    p, u = sample
    prior, seen = 0.3, []

    def adam(gradient, steps, rate):
        rng = np.random.default_rng(5)
        for _ in range(8):
            w, b = np.zeros(linear.N_FEATURES), float(rng.normal())
            w[:4] = rng.normal(0, 1, 4)
            gw, gb = gradient(w, b)
            first, negative = _risk(p.astype(float), u.astype(float), w, b, prior)
            # the minimised risk; where that of the negatives is below zero, a step back out of it
            value = lambda w, b: (lambda r: r[0] + r[1] if negative >= 0 else -r[1])(_risk(p.astype(float), u.astype(float), w, b, prior)) + 5e-5 * (w * w).sum()  # noqa: E731, B023
            for k in range(5):
                eps = 1e-5
                up, down = w.copy(), w.copy()
                if k < 4:
                    up[k] += eps
                    down[k] -= eps
                slope = (value(up, b + (k == 4) * eps) - value(down, b - (k == 4) * eps)) / (2 * eps)
                assert (gb if k == 4 else gw[k]) == pytest.approx(slope, abs=2e-4)
            seen.append(negative >= 0)
        return np.zeros(linear.N_FEATURES), 0.0

    monkeypatch.setattr(linear, "adam", adam)
    pu_quality.nn_pu(p, u, prior)
    monkeypatch.undo()
    assert len(seen) == 8
    model = pu_quality.nn_pu(p, u, prior)
    total = lambda w, b: (lambda r: r[0] + max(0.0, r[1]))(_risk(p, u, w, b, prior))
    assert total(model.weights, model.bias) < total(np.zeros(linear.N_FEATURES), 0.0)


def test_class_prior_is_between_bounds():
    rng = np.random.default_rng(8)
    p = rng.normal(3, 1, 4000)
    for share in (0.2, 0.5, 0.8):
        u = np.where(rng.random(4000) < share, rng.normal(3, 1, 4000), rng.normal(-3, 1, 4000))
        assert share - 0.1 < pu_quality.class_prior(p, u) <= share + 0.02


def test_platt_scaling_is_calibrated():
    rng = np.random.default_rng(2)
    x = np.zeros((5000, linear.N_FEATURES), np.float32)
    x[:, 0] = rng.normal(0, 2, 5000)
    y = (rng.random(5000) < 1 / (1 + np.exp(-0.5 * x[:, 0] - 0.3))).astype(float)
    w = np.zeros(linear.N_FEATURES)
    w[0] = 4.0
    model = linear.calibrate(linear.Model(w, 0.0), x, y)
    assert model.slope * 4.0 == pytest.approx(0.5, abs=0.06) and model.shift == pytest.approx(0.3, abs=0.1)


def test_features_and_scores_in_plain_python():
    texts = ["one two two one two", "", None, "Été\n1 2", "a " * 40 + "x" * 3000]
    rng = np.random.default_rng(1)
    model = linear.Model(rng.normal(size=linear.N_FEATURES), 0.2, 1.5, -0.1)
    got = linear.scores(model, pa.array(texts, pa.string()))
    for text, score in zip(texts, got):
        chunk = next(textnum.chunks(pa.array([text or ""])))
        x = linear.features(chunk)[0].astype(float)
        words = (text or "").split()
        terms = len(words) + max(0, len(words) - 1)
        block = x[: linear.BLOCK]
        assert (block > 0).sum() <= terms and (not terms or np.linalg.norm(block) == pytest.approx(1, abs=1e-5))
        grams = max(0, len((text or "").encode()) - 3)
        assert (x[linear.BLOCK : 2 * linear.BLOCK] > 0).sum() <= grams
        assert score == pytest.approx(1 / (1 + math.exp(-(1.5 * (float(x @ model.weights) + 0.2) - 0.1))))
    # a text is scored alike whatever stands beside it
    assert np.allclose(got, [linear.scores(model, pa.array([t], pa.string()))[0] for t in texts])


def test_quality_score_is_the_models(spark, monkeypatch):
    model = linear.Model(np.random.default_rng(6).normal(size=linear.N_FEATURES), 0.1, 1.2, 0.3)
    monkeypatch.setattr(quality_rules, "fit", lambda *a, **k: model)
    texts = [f"word{i} and other words that are told apart by {i} alone as is right" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(linear.scores(model, pa.array(texts))))
    for r in quality_rules.judge(docs, docs).collect():
        assert r.score == pytest.approx(want[r.doc_id]) and r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


# --- odd tables of operators that had no such test ------------------------------------------


def test_empty_tables(spark):
    assert lm_score.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    captures = spark.createDataFrame([("http://a.b/", 1)], "url string, fetched_at int")
    entries = spark.createDataFrame([], "list string, kind string, value string, active boolean, at int")
    assert [(r.blocked, r.lists) for r in url_filter.url_filter(captures, entries).collect()] == [(False, "")]
    assert url_filter.url_filter(captures.limit(0), entries).count() == 0


def test_very_long_texts_and_clashing_columns(spark):
    long = "x\r\n\r\n" + "é" * 2_000_000
    pages = spark.createDataFrame([(1, "http://a/" + "p/" * 3000, long, "r", "h"), (2, "u", long, "r", "h")], "page_id long, url string, html string, record string, header string")
    got = sorted(warc.parse(warc.read(warc.write(pages))).collect())
    assert [(r.page_id, r.payload_bytes, r.record_type) for r in got] == [(1, len(long.encode()), "response"), (2, len(long.encode()), "revisit")]
    captures = spark.createDataFrame([("http://a.b/" + "q" * 100_000 + "/x", 5, "own", "own", 7)], "url string, fetched_at int, lists string, kind string, _t int")
    entries = spark.createDataFrame([("l", "host", "a.b", True, 1)], "list string, kind string, value string, active boolean, at int")
    r = url_filter.url_filter(captures, entries).first()
    assert (r.lists, r.kind, r["_t"], r.blocked) == ("l", "own", 7, True)
