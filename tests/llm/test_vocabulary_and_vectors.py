"""Resampling, token counts and centroids against plain Python of their rules."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

import __spark_entry__ as entry
from telemetra.llm import centroids, resample, token_counts
from telemetra.llm.heads import Summary
from tests.llm.test_llm import ODD, SCHEMA
from tests.test_entry import SF, _rows, con  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op11_resampling", "op13_centroids"])
def test_query_matches_sql(spark, con, name):  # noqa: F811
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


# --- heads --------------------------------------------------------------------


def test_summary_keeps_every_frequent_key():
    rng = random.Random(5)
    keys = [f"k{min(int(rng.paretovariate(0.6)), 100_000)}".encode() for _ in range(60_000)]
    own, true = Summary(100, 1 << 20), Counter(keys)
    for i in range(0, len(keys), 500):
        part = Counter(keys[i : i + 500])
        own.add(pa.array(list(part), pa.binary()), np.array(list(part.values())))
    t = own.shrink()
    found = dict(zip(t["key"].to_pylist(), t["n"].to_pylist()))
    assert len(found) <= 100 and all(n <= true[k] for k, n in found.items())
    assert all(k in found for k, n in true.items() if n > len(keys) / 100)


def test_summary_is_bounded_in_bytes():
    own = Summary(100, 1000)
    own.add(pa.array([b"x" * 600, b"y" * 600, b"z"], pa.binary()), np.array([5, 9, 1]))
    assert own.shrink()["key"].to_pylist() == [b"y" * 600]


# --- token counts --------------------------------------------------------------


def test_token_counts_against_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(3)
    alphabet = [" ", "  ", "\n", "\t", "\r\n", "▁", "a", "the", "Über", "日本", "\x00", "ｆ", "<s>", "</s>", "<unk>", "12", ".", "​", " ", "🙂", "é"]
    texts = [None, "", " ", "\n", "▁", "  \n \n\n  ", "▁▁ ▁", "x" * 5000, "a " * 5000, "the cat sat\n" * 300]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(300)]
    docs = [(i, t, "other") for i, t in enumerate(texts)] + [(None, "the cat", "x"), (7, "the cat", "x"), (7, "the cat", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_tokens string").repartition(3)
    want = sorted((str(i), len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 50) for i, t, _ in docs)
    for bounds in ({"head_size": 4}, {"head_bytes": 0}, {}):
        got = token_counts.token_counts(frame, Path(MODEL).read_bytes(), limit=50, **bounds).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts.token_counts(frame.limit(0), Path(MODEL).read_bytes()).count() == 0


def test_token_counts_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = entry.queries()["op12_token_counts"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(sp.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


def test_each_rare_pre_token_meets_its_count_in_one_partition(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    plan = token_counts.token_counts(frame, Path(MODEL).read_bytes())._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan[: plan.index("RepartitionByExpression")]  # no text beyond the shuffle


# --- resampling ------------------------------------------------------------------


def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [" ".join(p) for p in zip(words, words[1:])]


def _resampled(docs, target, least, share, n=resample.BUCKETS):
    bucket = lambda g: zlib.crc32(g.encode()) % n
    s, t = (Counter(bucket(g) for x in texts for g in _features(x)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + n) / ((s[b] + 1) * (all_t + n))))
    out = []
    for i, text in docs:
        words, own = _features(text)
        weight = sum(gain(bucket(g)) for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = drawn[: share[0] * len(drawn) // share[1]]
    return out, [r[:4] for r in drawn]


@pytest.mark.parametrize("head", [(0, 0), (3, 3), (1 << 15, 1 << 16)])
def test_resampling_against_brute_force(spark, head, monkeypatch):
    monkeypatch.setattr(resample.weights, "__defaults__", (resample.BUCKETS, *head))
    texts = [f"the cat sat on the mat {i % 5} " * (i % 9) + f"w{i} Ünï\x00x{i}" for i in range(80)]
    docs = [(r[0], r[1]) for r in ODD] + [(100 + i, x) for i, x in enumerate(texts)] + [(100, texts[0])]
    target = ["the cat sat", "W3 on the mat", None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out, drawn = _resampled(docs, target, 5, (1, 3))
    rows = resample.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), (1, 3), 5).collect()
    key = lambda r: str(r)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score) for r in rows], key=key) == sorted([r[:4] for r in out], key=key)
    got = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in got] == drawn


def test_resampling_odd_tables(spark):
    odd, none = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame([], "text string")
    clash = odd.withColumnRenamed("size", "row").withColumnRenamed("score", "rank").withColumnRenamed("lang", "weight")
    drawn = resample.draw(clash, none, share=(1, 1), least_words=1)
    assert drawn.columns == clash.columns
    words = [r for r in ODD if _features(r[1])[0]]
    assert sorted(map(str, drawn.collect())) == sorted(map(str, clash.filter("text <> ''").collect())) and drawn.count() == len(words)
    assert resample.resample(odd.limit(0), none).count() == 0


# --- centroids ---------------------------------------------------------------------


@pytest.mark.parametrize("dim,bits", [(2, 3), (3, 2), (5, 1)])
def test_hilbert_order_visits_neighbours(dim, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
    keys = [k.tobytes() for k in centroids.hilbert_keys(cells, bits)]
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells)
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_candidates_lose_no_nearest_centroid():
    rng = np.random.default_rng(1)
    for _ in range(300):
        middle, spread = rng.integers(-50, 50, 6), rng.integers(1, 40)
        x = middle + rng.integers(-spread, spread + 1, (20, 6))
        c = rng.integers(-60, 60, (7, 6))
        every = centroids.nearest(x, c, np.arange(7))
        among = centroids.candidates(x.min(axis=0).astype(np.int32), x.max(axis=0).astype(np.int32), c)
        assert all((p == q).all() for p, q in zip(every, centroids.nearest(x, c, among)))


def _clustered(vectors, k, rounds, dim, seed=3):
    kept = [(i, [math.floor(1024 * v) for v in e]) for i, e in vectors if e is not None and len(e) == dim and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [x for _, x in order[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min(range(len(centre)), key=lambda c: (far(x, centre[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x), []).append(x)
        centre = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else centre[c] for c in range(len(centre))]
    rows = [(i, nearest(x), far(x, centre[nearest(x)])) for i, x in kept]
    inertia = Counter()
    for _, c, d in rows:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in rows]


def test_clustering_against_brute_force(spark):
    rng = random.Random(2)
    middles = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(5)]
    vectors = [(i, [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]) for i in range(300)]
    vectors += [(500 + i, [0.25, 0.5, -0.125, 0.0]) for i in range(100)]  # one very common vector, on exact ties
    vectors += [(7, [0.1] * 4), (None, [0.2] * 4), (None, [0.2] * 4), (900, None), (901, []), (902, [0.1] * 3), (903, [0.1, None, 0.1, 0.1]), (904, [0.1, math.nan, 0.1, 0.1]), (905, [math.inf, 0.1, 0.1, 0.1])]
    frame = spark.createDataFrame([(i, e, "x") for i, e in vectors], "vec_id long, embedding array<double>, cluster string").repartition(3)
    got = centroids.cluster(frame, k=6, rounds=4, dim=4).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _clustered(vectors, 6, 4, 4)))


def test_clustering_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([(1, None)], schema)).count() == 0
    two = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)
    got = centroids.cluster(two, k=5, dim=2).collect()  # equal centroids: the second stays empty
    assert [(r.cluster, r.distance, r.inertia) for r in got] == [(0, 0, 0)] * 2
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), dim=2).collect()


def test_boxes_save_comparisons(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(4, 8)) * 5
    rows = [(i, (middles[i % 4] + rng.normal(size=8) * 0.2).tolist()) for i in range(2000)]
    whole = centroids.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 8, 1024)
    blocks = centroids.blocks_of(whole, 8, block=50)
    left, every = centroids.work_saved(blocks, centroids.fit(whole, blocks, 4, 3, 3))
    assert every == 8000 and left < every / 2
