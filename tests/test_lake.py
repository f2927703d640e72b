import uuid

import pytest
from pyspark.sql import functions as F

from telemetra.plans.clean import clean_telemetry, run_clean_job
from telemetra.sinks.lake import LakeTable

SCHEMA = "device_id string, ts string, seq int, v double"


def _table(spark, workdir, name="t"):
    import uuid

    return LakeTable(spark, workdir, f"{name}_{uuid.uuid4().hex[:8]}", ["device_id", "ts"], ["device_id"])


def _rows(df):
    return sorted((tuple(r) for r in df.select("device_id", "ts", "seq", "v").collect()), key=lambda r: (r[0] is not None, r))


def test_partition_text_stays_text(spark, workdir):
    t = _table(spark, workdir)
    df = spark.createDataFrame([("001", "a", 1, 1.0), (None, "b", 1, 2.0)], SCHEMA)
    t.insert_overwrite(df)
    assert sorted(r["device_id"] or "" for r in t.read().collect()) == ["", "001"]
    snap = t.read_snapshot()
    assert snap.columns == ["ts", "seq", "v", "device_id"]
    assert sorted(r["device_id"] or "" for r in snap.collect()) == ["", "001"]


def test_upsert_rewrites_only_touched_partitions(spark, workdir):
    t = _table(spark, workdir)
    t.overwrite(spark.createDataFrame([("a", "1", 1, 1.0), ("b", "1", 1, 2.0)], SCHEMA), ["seq"])
    first = t.current_version()
    t.upsert(spark.createDataFrame([("a", "1", 2, 5.0), ("a", "2", 1, 6.0)], SCHEMA), ["seq"])
    assert _rows(t.read()) == [("a", "1", 2, 5.0), ("a", "2", 1, 6.0), ("b", "1", 1, 2.0)]
    files = {r["f"] for r in t.read().where("device_id = 'b'").select(F.input_file_name().alias("f")).collect()}
    assert all(f"/{first}/" in f for f in files)  # untouched partition not copied
    files_a = {r["f"] for r in t.read().where("device_id = 'a'").select(F.input_file_name().alias("f")).collect()}
    assert all(f"/{t.current_version()}/" in f for f in files_a)


def test_delete_can_empty_a_partition(spark, workdir):
    t = _table(spark, workdir)
    t.insert_overwrite(spark.createDataFrame([(None, "1", 1, 1.0), ("a", "1", 1, 2.0), ("a", None, 1, 3.0)], SCHEMA))
    t.delete(t.read().where(F.col("device_id").isNull() | F.col("ts").isNull()))
    assert _rows(t.read()) == [("a", "1", 1, 2.0)]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {t.database}.{t.name}__{t.current_version()}").collect()]
    assert [p.split("/")[0] for p in parts] == ["device_id=a"]


def test_append_writes_only_the_new_rows(spark, workdir):
    t = _table(spark, workdir)
    t.insert_overwrite(spark.createDataFrame([("a", "1", 1, 1.0), ("b", "1", 1, 2.0)], SCHEMA))
    first = t.current_version()
    t.insert_append(spark.createDataFrame([("a", "2", 1, 3.0)], SCHEMA))
    files = {r["f"] for r in t.read().select(F.input_file_name().alias("f")).collect()}
    assert sum(f"/{first}/" in f for f in files) == 2  # both original files still read in place
    assert sum(f"/{t.current_version()}/" in f for f in files) == 1
    assert _rows(t.read()) == [("a", "1", 1, 1.0), ("a", "2", 1, 3.0), ("b", "1", 1, 2.0)]
    # an upsert of partition a rewrites (and compacts) it; b stays where it was
    t.upsert(spark.createDataFrame([("a", "1", 2, 9.0)], SCHEMA), ["seq"])
    files_a = {r["f"] for r in t.read().where("device_id = 'a'").select(F.input_file_name().alias("f")).collect()}
    assert all(f"/{t.current_version()}/" in f for f in files_a)
    assert _rows(t.read()) == [("a", "1", 2, 9.0), ("a", "2", 1, 3.0), ("b", "1", 1, 2.0)]


def test_append_keeps_duplicates_and_overwrite_dedups(spark, workdir):
    df = spark.createDataFrame([("a", "1", 1, 1.0), ("a", "1", 2, 2.0)], SCHEMA)
    t = _table(spark, workdir)
    t.insert_overwrite(df)
    t.insert_append(df)
    assert t.read().count() == 4
    t.overwrite(df, ["seq"])
    assert _rows(t.read()) == [("a", "1", 2, 2.0)]


def test_stepwise_commits_equal_the_fused_plan(spark, workdir):
    from telemetra.registry import telemetry

    tele = telemetry(spark, "/root/testdata/sf0.001")
    t = LakeTable(spark, workdir, "clean_steps", ["device_id", "event_ts"], ["device_id"])
    run_clean_job(t, tele, ["event_id"], fused=False)
    fused = clean_telemetry(tele, order_by=["event_id"])
    cols = ["event_id", "device_id", "event_ts", "temperature", "pressure", "humidity"]

    def rows(df):
        return sorted(
            tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()
        )

    assert rows(t.read()) == rows(fused)
    assert len(rows(fused)) == 950


def test_clean_leaves_no_null_readings_and_keeps_present_values(spark):
    from telemetra.registry import telemetry

    tele = telemetry(spark, "/root/testdata/sf0.001")
    out = clean_telemetry(tele)
    readings = ["temperature", "pressure", "humidity"]
    assert out.where(" OR ".join(f"{r} IS NULL" for r in readings)).count() == 0
    joined = tele.alias("a").join(out.alias("b"), "event_id")
    for r in readings:
        assert joined.where(F.col(f"a.{r}").isNotNull() & (F.col(f"a.{r}") != F.col(f"b.{r}"))).count() == 0


def test_partition_locations_survive_a_fresh_table_object(spark, workdir):
    for k in range(2):
        t = _table(spark, f"{workdir}/{k}")
        t.insert_overwrite(spark.createDataFrame([("a", "1", 1, 1.0), ("b", "1", 1, 2.0), (None, "1", 1, 3.0)], SCHEMA))
        fresh = LakeTable(spark, t.path, t.name, t.keys, t.partition_by)
        fresh.upsert(spark.createDataFrame([("a", "1", 2, 5.0)], SCHEMA), ["seq"])
        assert _rows(fresh.read()) == [(None, "1", 1, 3.0), ("a", "1", 2, 5.0), ("b", "1", 1, 2.0)]
        names = {
            r[0].split("/")[0]
            for r in spark.sql(f"SHOW PARTITIONS {t.database}.{t.name}__{fresh.current_version()}").collect()
        }
        assert names == {"device_id=a", "device_id=b", "device_id=__HIVE_DEFAULT_PARTITION__"}


def test_many_partitions_are_attached_in_chunks(spark, workdir, monkeypatch):
    import telemetra.sinks.lake as lake

    monkeypatch.setattr(lake, "ADD_PARTITION_CHUNK", 2)
    t = _table(spark, workdir)
    rows = [(f"d{i}", "1", 1, float(i)) for i in range(7)]
    t.insert_overwrite(spark.createDataFrame(rows, SCHEMA))
    t.upsert(spark.createDataFrame([("d0", "1", 2, 100.0)], SCHEMA), ["seq"])
    got = _rows(t.read())
    assert got == sorted([("d0", "1", 2, 100.0)] + rows[1:], key=lambda r: (r[0] is not None, r))


def test_append_with_fewer_and_more_columns(spark, workdir):
    t = _table(spark, workdir)
    t.insert_overwrite(spark.createDataFrame([("a", "1", 1, 1.0)], SCHEMA))
    t.insert_append(spark.createDataFrame([("a", "2", 7)], "device_id string, ts string, extra int"))
    got = sorted((tuple(r) for r in t.read().select("ts", "seq", "v", "extra").collect()))
    assert got == [("1", 1, 1.0, None), ("2", None, None, 7)]


def _typed(spark, workdir):
    return LakeTable(spark, workdir, f"typed_{uuid.uuid4().hex[:8]}", ["flag", "id"], ["flag"])


@pytest.mark.parametrize("kind, a, b", [("boolean", "true", "false"), ("timestamp", "2024-01-01 00:00:00.125", "2024-01-02 00:00:00"), ("string", "", "x y/z"), ("double", "1.5", "2")])
def test_partition_of_any_type_is_replaced_and_deleted(spark, workdir, kind, a, b):
    def rows(*xs):
        return spark.createDataFrame([(f, i, v) for f, i, v in xs], "flag string, id string, v int").withColumn("flag", F.col("flag").cast(kind))

    t = _typed(spark, workdir)
    t.overwrite(rows((a, "1", 1), (b, "1", 2)), ["v"])
    t.upsert(rows((a, "1", 3)), ["v"])
    assert sorted(r.v for r in t.read().collect()) == [2, 3]
    t.insert_append(rows((a, "2", 4)))
    assert sorted(r.v for r in t.read_snapshot().collect()) == [2, 3, 4]
    t.delete(rows((a, "1", 0), (a, "2", 0)))
    assert [r.v for r in t.read_snapshot().collect()] == [2]


def test_two_partition_columns_and_many_partitions(spark, workdir):
    t = LakeTable(spark, workdir, f"wide_{uuid.uuid4().hex[:8]}", ["a", "b"], ["a", "b"])
    rows = spark.range(600).select((F.col("id") % 30).cast("string").alias("a"), (F.col("id") / 30).cast("int").cast("string").alias("b"), F.col("id").alias("v"))
    t.overwrite(rows, ["v"])
    t.upsert(rows.withColumn("v", F.col("v") + 1000), ["v"])
    assert t.read().agg(F.count("v"), F.min("v")).first()[:] == (600, 1000)


def test_append_keeps_stored_types(spark, workdir):
    t = _table(spark, workdir)
    t.insert_overwrite(spark.createDataFrame([("a", "1", 1, 1.0)], SCHEMA))
    t.insert_append(spark.createDataFrame([("a", "2", 1, 2)], "device_id string, ts string, seq int, v int"))
    assert sorted(r.v for r in t.read().collect()) == [1.0, 2.0]
    with pytest.raises(ValueError):
        t.insert_append(spark.createDataFrame([("a", "3", 1.5, 2.0)], "device_id string, ts string, seq double, v double"))


def test_published_name_follows_and_stale_base_fails(spark, workdir):
    t = _table(spark, workdir)
    row = lambda ts: spark.createDataFrame([("a", ts, 1, 1.0)], SCHEMA)
    t.insert_overwrite(row("1"))
    name = t.register_as(f"{t.view}_published")
    base = t.current_version()
    t.insert_append(row("2"))
    assert spark.table(name).count() == 2
    with pytest.raises(RuntimeError):
        t._commit(row("3"), None, append=True, base=base)


def test_rebalanced_write_makes_one_file_per_partition(spark, workdir):
    t = _table(spark, workdir)
    t.insert_overwrite(spark.range(2000).repartition(16).select(F.concat(F.lit("d"), F.col("id") % 20).alias("device_id"), F.col("id").cast("string").alias("ts"), F.lit(1).alias("seq"), F.lit(1.0).alias("v")))
    assert len(t.read().inputFiles()) <= 40
