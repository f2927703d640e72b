import uuid

import pytest
from pyspark.sql import functions as F

from telemetra.functions.predicates import event_pattern
from telemetra.operators.infer import inferred_fields, inferred_schema, register_inferred_table
from telemetra.operators.inspect import capped_scan, schema_report
from telemetra.sources.tables import catalog_scan, read_unwrapped_items, register_external
from telemetra.streaming.changes import refresh_on_change


def test_inferred_fields_merge_types_and_union_keys(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5, "c": true}',), ("nope",)], "j string")
    got = {r["field"]: (r["data_type"], r["n_records"]) for r in inferred_fields(df, "j").collect()}
    assert got["b"] == ("STRING", 1) and got["c"] == ("BOOLEAN", 1)
    assert got["a"][0].startswith("DECIMAL") and got["a"][1] == 2
    assert inferred_schema(df, "j").collect()[0]["schema"].startswith("OBJECT<a:")


def test_register_inferred_table(spark, workdir):
    df = spark.createDataFrame([('{"device": "d", "n": 1}',)], "j string")
    name = f"telemetra_t.inferred_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS telemetra_t LOCATION '{workdir}/db'")
    register_inferred_table(spark, inferred_fields(df, "j"), name, f"{workdir}/data")
    assert dict(spark.table(name).dtypes) == {"device": "string", "n": "bigint"}


def test_external_registration_and_catalog_scan(spark, workdir):
    spark.range(5).write.parquet(f"{workdir}/p")
    name = register_external(spark, f"telemetra_t.ext_{uuid.uuid4().hex[:8]}", f"{workdir}/p", database_location=f"{workdir}/db2")
    assert catalog_scan(spark, name).count() == 5


def test_item_lines_with_bad_lines(spark, workdir):
    lines = ['{"device_id":{"S":"d1"},"temperature":{"N":"21.5"},"ok":{"BOOL":true}}', "garbage"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{workdir}/items")
    rows = read_unwrapped_items(spark, f"{workdir}/items", {"device_id": "string", "temperature": "double", "ok": "boolean"}).collect()
    assert sorted(rows, key=lambda r: r["device_id"] or "") == sorted(
        [(None, None, None), ("d1", 21.5, True)], key=lambda r: r[0] or ""
    )


def test_capped_scan_needs_an_order(spark):
    df = spark.range(100)
    with pytest.raises(ValueError):
        capped_scan(df, [], 5)
    assert [r["id"] for r in capped_scan(df, [F.col("id").desc()], 3).collect()] == [99, 98, 97]


def test_two_level_capped_scan_is_exact(spark):
    df = spark.range(0, 5000, numPartitions=16).select(((F.col("id") * 7919) % 5000).alias("k"))
    two = [r["k"] for r in capped_scan(df, ["k"], 50, groups=4).collect()]
    one = [r["k"] for r in capped_scan(df, ["k"], 50, groups=None).collect()]
    assert two == one == list(range(50))
    plan = capped_scan(df, ["k"], 50, groups=4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_schema_report_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a int, b string")
    got = [tuple(r) for r in schema_report(df).orderBy("position").collect()]
    assert got == [(0, "a", "int", True, 2), (1, "b", "string", True, 2)]


def test_event_pattern_nested_and_missing_fields(spark):
    df = spark.createDataFrame(
        [("a", "T", ("arn1",)), ("a", "T", ("arn2",)), ("b", "T", ("arn1",)), ("a", None, ("arn1",)), ("a", "T", None)],
        "source string, dt string, detail struct<arn:string>",
    )
    pat = {"source": ["a"], "dt": ["T"], "detail": {"arn": ["arn1"]}}
    assert df.where(event_pattern(pat)).count() == 1


def test_refresh_runs_only_on_a_match(spark, workdir):
    body = '{"source":"x","detail-type":"y","detail":{"eventSourceARN":"z"}}'
    spark.createDataFrame([(body,)], "value string").write.text(f"{workdir}/ch")
    calls = []

    def job():
        calls.append(1)
        return spark.range(1)

    out = refresh_on_change(spark, f"{workdir}/ch", {"source": ["nomatch"]}, f"{workdir}/m", f"{workdir}/ck", job)
    assert out is None and calls == []
    out = refresh_on_change(spark, f"{workdir}/ch", {"source": ["x"]}, f"{workdir}/m2", f"{workdir}/ck2", job)
    assert out is not None and calls == [1]
    for _ in range(2):  # the event has been served
        assert refresh_on_change(spark, f"{workdir}/ch", {"source": ["x"]}, f"{workdir}/m2", f"{workdir}/ck2", job) is None
    assert calls == [1]


def test_records_union_keys_and_fill_missing(spark, workdir):
    from telemetra.sources.tables import read_records

    lines = ['{"device_id":"d1","temperature":21.5}', '{"device_id":"d2","humidity":40,"ok":true}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{workdir}/rec")
    df = read_records(spark, f"{workdir}/rec")
    assert sorted(df.columns) == ["device_id", "humidity", "ok", "temperature"]
    rows = {r["device_id"]: r for r in df.collect()}
    assert rows["d1"]["humidity"] is None and rows["d2"]["temperature"] is None and rows["d2"]["ok"] is True
