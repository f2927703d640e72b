"""Operators vs. a plain-Python brute force on random small tables."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telemetra.operators.keyed import delete_keys, latest_per_key, upsert_rows
from telemetra.operators.quality import impute_mean, sparse_rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k1 string, k2 bigint, seq bigint, v double"

key1 = st.sampled_from(["a", "b", None])
key2 = st.sampled_from([1, 2, None])
value = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False), st.just(float("nan")))


def rows_strategy(max_size=25):
    return st.lists(st.tuples(key1, key2, value), max_size=max_size).map(
        lambda rs: [(k1, k2, i, v) for i, (k1, k2, v) in enumerate(rs)]
    )


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _norm(rows):
    def n(x):
        if isinstance(x, float) and math.isnan(x):
            return "nan"
        return x

    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


def _latest(rows):
    best = {}
    for r in rows:
        k = (r[0], r[1])
        if k not in best or r[2] > best[k][2]:
            best[k] = r
    return list(best.values())


@SETTINGS
@given(rows=rows_strategy())
def test_latest_per_key_matches_brute_force(spark, rows):
    out = latest_per_key(_df(spark, rows), ["k1", "k2"], ["seq"]).collect()
    assert _norm(tuple(r) for r in out) == _norm(_latest(rows))


@SETTINGS
@given(target=rows_strategy(), deletes=rows_strategy(8))
def test_delete_keys_matches_brute_force(spark, target, deletes):
    gone = {(r[0], r[1]) for r in deletes}
    want = [r for r in target if (r[0], r[1]) not in gone]
    out = delete_keys(_df(spark, target), _df(spark, deletes), ["k1", "k2"]).collect()
    assert _norm(tuple(r) for r in out) == _norm(want)


@SETTINGS
@given(target=rows_strategy(), source=rows_strategy(10))
def test_upsert_matches_brute_force(spark, target, source):
    base = _latest(target)
    source = [(k1, k2, 1000 + s, v) for k1, k2, s, v in source]
    newer = _latest(source)
    replaced = {(r[0], r[1]) for r in newer}
    want = [r for r in base if (r[0], r[1]) not in replaced] + newer
    t = latest_per_key(_df(spark, target), ["k1", "k2"], ["seq"])
    out = upsert_rows(t, _df(spark, source), ["k1", "k2"], ["seq"]).collect()
    assert _norm(tuple(r) for r in out) == _norm(want)


@SETTINGS
@given(rows=rows_strategy())
def test_impute_matches_brute_force(spark, rows):
    present = [r[3] for r in rows if r[3] is not None and not math.isnan(r[3])]
    if not present:
        return
    mean = sum(present) / len(present)
    out = {r["seq"]: r["v"] for r in impute_mean(_df(spark, rows), ["v"]).collect()}
    for r in rows:
        want = r[3] if r[3] is not None and not math.isnan(r[3]) else mean
        assert math.isclose(out[r[2]], want, rel_tol=1e-9, abs_tol=1e-6)


@SETTINGS
@given(rows=st.lists(st.tuples(value, value, value), max_size=20), inclusive=st.booleans())
def test_sparse_rows_match_brute_force(spark, rows, inclusive):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id bigint, a double, b double, c double")
    got = {r["id"] for r in sparse_rows(df, ["a", "b", "c"], 2, inclusive=inclusive).collect()}
    want = set()
    for i, *vals in data:
        n = sum(v is None for v in vals)
        if (n >= 2) if inclusive else (n > 2):
            want.add(i)
    assert got == want
