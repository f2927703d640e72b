import math

import pytest
from pyspark.sql import functions as F

from telemetra.functions.casts import cast_readings
from telemetra.functions.nulls import half_threshold, non_key_columns, null_count
from telemetra.operators.quality import (
    column_means,
    drop_null_keys,
    drop_sparse_rows,
    impute_mean,
    null_key_rows,
    sparse_rows,
)


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, 3.0)], "id int, x double")
    means = column_means(df, ["x"]).collect()[0]
    assert means["x_mean"] == pytest.approx(2.0)
    out = {r["id"]: r["x"] for r in impute_mean(df, ["x"]).collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 2.0, 4: 3.0}


def test_integer_readings_are_cast_to_double_first(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 4), (4, 6)], "id int, x int")
    out = impute_mean(cast_readings(df, ["x"]), ["x"])
    assert dict(out.dtypes)["x"] == "double"
    filled = {r["id"]: r["x"] for r in out.collect()}[2]
    assert filled == pytest.approx(11 / 3)


def test_float_column_keeps_its_type(spark):
    df = spark.createDataFrame([(1, 1.1), (2, 2.2), (3, None)], "id int, x float")
    out = impute_mean(df, ["x"])
    assert dict(out.dtypes)["x"] == "float"
    filled = {r["id"]: r["x"] for r in out.collect()}[3]
    assert filled == pytest.approx(1.65, rel=1e-6)


def test_all_null_column_errors_by_default_or_is_kept(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    with pytest.raises(Exception, match="cannot impute"):
        impute_mean(df, ["x"]).collect()
    kept = impute_mean(df, ["x"], on_all_null="keep").collect()
    assert [r["x"] for r in kept] == [None, None]


def test_malformed_number_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("zz",), ("",), (None,)], "x string")
    assert [r["x"] for r in cast_readings(df, ["x"]).collect()] == [1.5, None, None, None]


def test_null_keys_found_and_dropped(spark):
    df = spark.createDataFrame([(None, "2", 1.0), ("b", None, 2.0), ("a", "1", 3.0)], "k1 string, k2 string, v double")
    assert sorted(r["v"] for r in null_key_rows(df, ["k1", "k2"]).collect()) == [1.0, 2.0]
    assert [r["v"] for r in drop_null_keys(df, ["k1", "k2"]).collect()] == [3.0]


def test_sparse_thresholds(spark):
    rows = [(i, *vals) for i, vals in enumerate([(1.0, 1.0, 1.0), (None, 1.0, 1.0), (None, None, 1.0), (None, None, None)])]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    thr = half_threshold(2 + 3)
    assert thr == 2
    strict = {r["id"] for r in sparse_rows(df, ["a", "b", "c"], thr).collect()}
    inclusive = {r["id"] for r in sparse_rows(df, ["a", "b", "c"], thr, inclusive=True).collect()}
    assert strict == {3} and inclusive == {2, 3}
    assert {r["id"] for r in drop_sparse_rows(df, ["a", "b", "c"], thr).collect()} == {0, 1, 2}


def test_null_count_and_non_key_columns(spark):
    df = spark.createDataFrame([(None, 1.0, None)], "a double, b double, c double")
    assert df.select(null_count(["a", "b", "c"]).alias("n")).collect()[0]["n"] == 2
    assert non_key_columns(["k", "a", "t"], ["k", "t"]) == ["a"]


def test_nan_is_not_counted_as_null(spark):
    df = spark.createDataFrame([(float("nan"), None)], "a double, b double")
    assert df.select(null_count(["a", "b"]).alias("n")).collect()[0]["n"] == 1


def test_imputation_keeps_non_null_values_and_means(spark):
    df = spark.range(0, 200).select(
        F.col("id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 1.5).alias("x")
    )
    before = column_means(df, ["x"]).collect()[0]["x_mean"]
    out = impute_mean(df, ["x"])
    after = column_means(out, ["x"]).collect()[0]["x_mean"]
    assert math.isclose(before, after, rel_tol=1e-12)
    assert out.where(F.col("x").isNull()).count() == 0
    joined = df.alias("a").join(out.alias("b"), "id").where(F.col("a.x").isNotNull())
    assert joined.where(F.col("a.x") != F.col("b.x")).count() == 0
