"""L1 / S2 at any cap by one plan, and A1 with the same bits under any partitioning."""

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from telemetra.operators.inspect import capped_scan, first_rows_bound
from telemetra.operators.quality import column_means, impute_mean

ROWS = 20_000


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    rng = random.Random(11)
    day = datetime(2024, 1, 1)
    rows = [
        (
            i,
            None if i % 50 == 0 else rng.randrange(10**6),
            7 if i % 3 else rng.randrange(20),  # two thirds of all rows tie
            rng.choice([None, math.nan, math.inf, -0.0, 0.0, rng.gauss(0, 1), rng.gauss(0, 1)]),
            rng.choice([None, "", "abcdefgh", "abcdefgi"]) if i % 4 else f"k{rng.randrange(5000)}",
            day + timedelta(seconds=rng.randrange(10**7)),
        )
        for i in range(ROWS)
    ]
    path = str(tmp_path_factory.mktemp("page"))
    df = spark.createDataFrame(rows, "id int, u long, tied int, x double, s string, at timestamp_ntz")
    df.repartition(12).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


ORDERS = [["id"], ["u", "id"], ["u DESC", "id"], ["tied", "id"], ["tied DESC", "u DESC", "id"], ["x", "id"], ["x DESC", "id"], ["s", "id"], ["s DESC", "id"], ["at DESC", "id"], ["at", "id"]]


@pytest.mark.parametrize("order", ORDERS, ids=" ".join)
@pytest.mark.parametrize("n", [1, 10, 3000, 10_000])
def test_page_is_the_exact_top_n(frame, order, n):
    plain = [F.col(o.split()[0]).desc() if o.endswith("DESC") else F.col(o) for o in order]
    want = [r.id for r in frame.orderBy(*plain).limit(n).select("id").collect()]
    assert [r.id for r in capped_scan(frame, order, n).select("id").collect()] == want


@pytest.mark.parametrize("order", [o for o in ORDERS if o[0][0] != "s"], ids=" ".join)
@pytest.mark.parametrize("n", [10, 3000])
def test_few_rows_reach_the_merge(frame, order, n):
    bound = first_rows_bound(frame, order, n)
    assert bound is not None and n <= frame.where(bound).count() <= 2 * n + 5


def test_same_plan_at_every_cap(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    plans = []
    for n in (10, 10_000):
        df_n = capped_scan(df, order, n)
        plan = df_n._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(l_orderkey" in plan  # the bound reaches the scan
        plans.append([line.strip(" +-*()0123456789").split("(")[0].split(" ")[0] for line in plan.splitlines() if line.strip()])
    assert plans[0] == plans[1] and not any("Window" in x or x == "Exchange" for x in plans[0])


def test_page_of_small_and_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    assert [r.a for r in capped_scan(df, ["b", "a"], 2).collect()] == [1, 2]
    assert [r.a for r in capped_scan(df, ["b DESC", "a DESC"], 2).collect()] == [3, 2]
    assert capped_scan(df.limit(0), ["a"], 5).count() == 0
    same = spark.range(1000).select(F.lit(1).alias("k"))
    assert capped_scan(same, ["k"], 10).count() == 10  # rows that tie in everything
    nulls = spark.range(1000).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    for order in (["k", "v"], ["k DESC", "v"]):
        assert [r.v for r in capped_scan(nulls, order, 3).collect()] == [0, 1, 2]


# --- means --------------------------------------------------------------------------------


def _means(df, **kw):
    return tuple(column_means(df, [c for c in df.columns if c != "k"], **kw).first())


def test_means_have_the_same_bits_under_any_partitioning(spark):
    rng = random.Random(7)
    rows = [(i, rng.uniform(-1, 1) * 10 ** rng.randint(-15, 12), rng.gauss(20, 5), rng.randrange(-(2**60), 2**60)) for i in range(5000)]
    rows += [(k, None, math.nan, None) for k in range(20)]
    df = spark.createDataFrame(rows, "k int, a double, b float, c long")
    found = {_means(df.repartition(n, F.rand(n))) for n in (1, 7, 64)}
    assert len(found) == 1
    a, b, c = found.pop()
    exact = sum(Fraction(r[1]) for r in rows if r[1] is not None) / 5000
    assert a == pytest.approx(float(exact), rel=1e-15, abs=1e-18)
    assert c == pytest.approx(float(Fraction(sum(r[3] for r in rows[:5000]), 5000)), rel=1e-15)
    assert len({_means(df.repartition(n, F.rand(n)), exact=False) for n in (1, 7, 64)}) > 1  # what it is there for


def test_means_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 1e300, 0.1, -0.0, 2.0**59), (2.0, None, 1e300, 0.1, -0.5, -(2.0**59))], "a double, n double, h double, t double, z double, w double")
    assert _means(df) == (1.5, None, 1e300, 0.1, -0.25, 0.0)
    assert _means(df.limit(0)) == (None,) * 6
    with_inf = spark.createDataFrame([(math.inf,), (1.0,)], "a double")
    assert _means(with_inf) == (math.inf,)


def test_imputed_values_are_equal_under_any_partitioning(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, None if i % 9 == 0 else rng.gauss(20, 5)) for i in range(3000)], "k int, a double")
    out = {tuple(r.a for r in impute_mean(df.repartition(n, F.rand(n)), ["a"]).orderBy("k").collect()) for n in (1, 5, 40)}
    assert len(out) == 1
