from pyspark.sql import functions as F

from telemetra.operators.keyed import delete_keys, latest_per_key, upsert_rows

SCHEMA = "k1 string, k2 string, seq int, v double"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_per_key_takes_last_by_order(spark):
    df = spark.createDataFrame([("a", "1", 1, 1.0), ("a", "1", 3, 3.0), ("a", "1", 2, 2.0), ("b", "1", 1, 9.0)], SCHEMA)
    out = latest_per_key(df, ["k1", "k2"], ["seq"])
    assert _rows(out, "k1", "v") == [("a", 3.0), ("b", 9.0)]


def test_latest_per_key_plans_a_partial_group_limit(spark):
    df = spark.createDataFrame([("a", "1", 1, 1.0)], SCHEMA)
    plan = latest_per_key(df, ["k1", "k2"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k1"),
        F.lit("x").alias("k2"),
        F.col("id").cast("int").alias("seq"),
        F.col("id").cast("double").alias("v"),
    )
    out = latest_per_key(df, ["k1", "k2"], ["seq"])
    assert out.where("k1 = 'hot'").collect()[0]["v"] == 19998.0
    assert out.count() == 20000 - 6667 + 1


def test_delete_is_by_key_and_null_safe(spark):
    target = spark.createDataFrame(
        [(None, "2", 1, 1.0), ("b", None, 1, 2.0), ("c", "3", 1, 3.0), ("c", "3", 2, 4.0), ("d", "4", 1, 5.0)], SCHEMA
    )
    rows = spark.createDataFrame([(None, "2", 9, 0.0), ("b", None, 9, 0.0), ("c", "3", 9, 0.0)], SCHEMA)
    out = delete_keys(target, rows, ["k1", "k2"])
    assert _rows(out, "k1", "v") == [("d", 5.0)]
    # deleting again changes nothing
    assert _rows(delete_keys(out, rows, ["k1", "k2"]), "k1", "v") == [("d", 5.0)]


def test_upsert_replaces_whole_rows_and_inserts(spark):
    target = spark.createDataFrame([("a", "1", 1, 1.0), ("b", "1", 1, 2.0)], SCHEMA)
    source = spark.createDataFrame([("a", "1", 2, None), ("a", "1", 1, 7.0), ("c", "1", 1, 3.0)], SCHEMA)
    out = upsert_rows(target, source, ["k1", "k2"], ["seq"])
    assert _rows(out, "k1", "seq", "v") == [("a", 2, None), ("b", 1, 2.0), ("c", 1, 3.0)]
    again = upsert_rows(out, source, ["k1", "k2"], ["seq"])
    assert _rows(again, "k1", "seq", "v") == _rows(out, "k1", "seq", "v")


def test_upsert_keys_unique(spark):
    target = spark.range(0, 500).select((F.col("id") % 50).cast("string").alias("k1"), F.lit("x").alias("k2"),
                                        F.col("id").cast("int").alias("seq"), F.col("id").cast("double").alias("v"))
    t = latest_per_key(target, ["k1", "k2"], ["seq"])
    out = upsert_rows(t, target, ["k1", "k2"], ["seq"])
    assert out.count() == out.select("k1", "k2").distinct().count() == 50


def test_stage_round_trips_and_cuts_lineage(spark):
    from telemetra.operators.staging import stage

    df = spark.range(0, 100).select((F.col("id") % 7).alias("k")).dropDuplicates()
    staged = stage(df, "test-stage")
    assert sorted(r["k"] for r in staged.collect()) == list(range(7))
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Relation" in plan  # a file scan, not the original plan
