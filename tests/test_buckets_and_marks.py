"""K2 / K5 in key buckets, commit marks, merge-on-read and the stateful keyed put."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telemetra.sinks.lake import LakeTable
from telemetra.streaming.changes import refresh_table_on_change
from telemetra.streaming.ingest import batch_rows, broker_rows, current_items, fold_log, latest_items, read_log, start_ingest, start_keyed_state
from tests.test_streaming import _msg, _state, _write

KEYS = ("device_id", "timestamp")


def _lake(spark, path, **kw):
    return LakeTable(spark, path, f"b_{uuid.uuid4().hex[:8]}", kw.pop("keys", KEYS), **kw)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- buckets -----------------------------------------------------------------------


def test_many_devices_few_partitions_and_a_pruned_scan(spark, workdir):
    t = _lake(spark, workdir, keys=("device_id",), buckets=16)
    t.overwrite(spark.range(100_000).select(F.concat(F.lit("d"), "id").alias("device_id"), F.col("id").alias("v")), ["v"])
    t.upsert(spark.range(100_000).select(F.concat(F.lit("d"), F.col("id") + 50_000).alias("device_id"), (F.col("id") + 1_000_000).alias("v")), ["v"])
    listed = spark.sql(f"SHOW PARTITIONS {t._version_table(t.current_version())}").collect()
    assert len(listed) == 16
    assert t.read().count() == 150_000 and t.read().where("v >= 1000000").count() == 100_000
    assert t.read().columns == ["device_id", "v"]

    one = spark.createDataFrame([("d7", -1)], "device_id string, v long")
    scoped, touched = t._scoped(one)
    assert len(touched) == 1 and scoped.count() < 150_000 / 8
    assert "_bucket" in _plan(scoped).split("PartitionFilters: [")[1].split("]")[0]
    kept = {f for f in t.read().inputFiles()}
    t.upsert(one, ["v"])
    assert t.read().where("device_id = 'd7'").first().v == -1
    new = {f for f in t.read().inputFiles()} - kept
    assert len(new) == 1 and len(kept & set(t.read().inputFiles())) == len(kept) - 1
    t.delete(one)
    assert t.read().where("device_id = 'd7'").count() == 0 and t.read().count() == 149_999


def test_bucketed_keys_of_other_types_and_nulls(spark, workdir):
    t = _lake(spark, workdir, keys=("k", "x"), buckets=3, bucket_by=("k",))
    t.overwrite(spark.createDataFrame([(1, "a", 1), (None, "a", 2), (2, None, 3)], "k long, x string, v int"), ["v"])
    t.upsert(spark.createDataFrame([(1, "a", 10), (None, "a", 20)], "k int, x string, v int"), ["v"])  # a narrower key type
    t.insert_append(spark.createDataFrame([(5, "", 4)], "k int, x string, v int"))
    assert sorted((tuple(r) for r in t.read().collect()), key=str) == sorted([(1, "a", 10), (None, "a", 20), (2, None, 3), (5, "", 4)], key=str)
    t.delete(spark.createDataFrame([(2, None), (5, "")], "k long, x string"))
    assert sorted(r.v for r in t.read().collect()) == [10, 20]
    assert sorted(r.v for r in t.read_snapshot().collect()) == [10, 20]


def test_bucket_arguments(spark, workdir):
    for bad in ({"buckets": 0}, {"buckets": 2, "partition_by": ("device_id",)}, {"buckets": 2, "bucket_by": ("v",)}):
        with pytest.raises(ValueError):
            _lake(spark, workdir, **bad)


def test_partitioned_upsert_prunes_by_the_touched_side(spark, workdir):
    t = LakeTable(spark, workdir, f"p_{uuid.uuid4().hex[:8]}", KEYS, ("device_id",))
    t.insert_overwrite(spark.range(400).select(F.concat(F.lit("d"), F.col("id") % 40).alias("device_id"), F.col("id").cast("string").alias("timestamp"), F.lit(1).alias("v")))
    scoped, touched = t._scoped(spark.createDataFrame([("d3", "3", 2), ("", "x", 1)], "device_id string, timestamp string, v int"))
    assert sorted(touched, key=str) == [("d3",), (None,)]
    assert scoped.count() == 10
    assert "dynamicpruning" in _plan(scoped).lower()


# --- marks ---------------------------------------------------------------------------


def test_marks_move_with_their_rows(spark, workdir):
    t = _lake(spark, workdir, buckets=2)
    row = spark.createDataFrame([("a", "1", 1)], "device_id string, timestamp string, v int")
    assert t.mark("log") == -1
    t.overwrite(row, ["v"], marks={"log": 3, "other": 1})
    t.upsert(row, ["v"], marks={"log": 4})
    assert t.marks() == {"log": 4, "other": 1}
    t.delete(row)
    assert t.marks() == {"log": 4, "other": 1} and t.read().count() == 0


@pytest.fixture
def folded(spark, workdir):
    src, log, ck = f"{workdir}/src", f"{workdir}/log", f"{workdir}/ck"
    table = _lake(spark, f"{workdir}/lake", buckets=4)

    def arrive(name, *lines):
        _write(spark, f"{src}/{name}", list(lines))
        start_ingest(spark, f"{src}/*", log, ck).awaitTermination()

    return table, log, arrive


def test_a_fold_repeated_after_a_crash_is_a_no_op(spark, folded, monkeypatch):
    table, log, arrive = folded
    arrive("a1", _msg("d1", "t1", 1.0), _msg("d2", "t1", 2.0))
    assert fold_log(table, spark, log) == 0
    first = table.current_version()
    assert fold_log(table, spark, log) == 0 and table.current_version() == first
    arrive("a2", _msg("d1", "t1", 9.0))
    write, switch = LakeTable._commit, []

    def crash(self, *args, **kw):  # before the commit: nothing of it is seen
        switch.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(LakeTable, "_commit", crash)
    with pytest.raises(RuntimeError):
        fold_log(table, spark, log)
    monkeypatch.setattr(LakeTable, "_commit", write)
    assert switch and table.mark("log") == 0 and table.current_version() == first
    assert fold_log(table, spark, log) == 1 == table.mark("log")
    second = table.current_version()
    # a process that died before it could note the batch asks for it again
    assert fold_log(table, spark, log, after_batch=-1) == 1 and table.current_version() == second


def test_merged_view_equals_the_log_before_between_and_after_folds(spark, folded):
    table, log, arrive = folded

    def same():
        view = current_items(table, spark, log)
        want = sorted(map(str, latest_items(spark, log).collect()))
        assert sorted(map(str, view.collect())) == want
        return view

    arrive("a1", _msg("d1", "t1", 1.0), _msg("d1", "t1", 1.5), _msg("d2", "t1", 2.0), "nope")
    same()
    fold_log(table, spark, log)
    same()
    arrive("a2", _msg("d1", "t1", 9.0), _msg("d3", "t2", None))
    view = same()
    # of the log only the unfolded batch is read
    assert "batch_id#" in _plan(view) and "(batch_id#" in _plan(view).split("PartitionFilters: [")[-1]
    before = sorted(map(str, view.collect()))
    fold_log(table, spark, log)
    assert sorted(map(str, view.collect())) == before  # planned on one version, whatever is committed
    same()


def test_refresh_is_served_exactly_once(spark, workdir):
    table = _lake(spark, f"{workdir}/lake", buckets=2)
    body = '{"source":"x","detail-type":"y","detail":{"eventSourceARN":"z"}}'
    row = spark.createDataFrame([("a", "1", 1)], "device_id string, timestamp string, v int")
    calls = []

    def job(marks, crash=False):
        calls.append(marks)
        if crash:
            raise RuntimeError("lost")
        table.overwrite(row, ["v"], marks)

    def refresh(j=job):
        return refresh_table_on_change(table, f"{workdir}/ch", {"source": ["x"]}, f"{workdir}/m", f"{workdir}/ck", j)

    _write(spark, f"{workdir}/ch", [body])
    with pytest.raises(RuntimeError, match="lost"):
        refresh(lambda marks: job(marks, crash=True))
    assert refresh() and not refresh()  # the event of the lost job is served, once
    spark.createDataFrame([(body,)], "value string").write.mode("append").text(f"{workdir}/ch")
    with pytest.raises(RuntimeError, match="marks"):
        refresh(lambda marks: None)
    assert refresh() and not refresh()
    assert [m["changes"] for m in calls] == [0, 0, 1]


# --- arrival and state ------------------------------------------------------------------


def test_broker_order_is_by_offset(spark, workdir):
    late = datetime(2030, 1, 1)
    raw = spark.createDataFrame(
        [
            (_msg("d1", "t1", 1.0), "telemetry_data", 0, 5, late),  # an older message with a late clock
            (_msg("d1", "t1", 2.0), "telemetry_data", 0, 6, datetime(2020, 1, 1)),
            (_msg("d1", "t1", 0.0), "telemetry_data", 0, 4, late),
            (_msg("d2", "t1", 7.0), "telemetry_data", 11, 1, late),
            (_msg("d9", "t1", 7.0), "other", 0, 1, late),
        ],
        "value string, topic string, partition int, offset long, timestamp timestamp",
    )
    rows = batch_rows(broker_rows(raw.withColumn("value", F.col("value").cast("binary"))), 0)
    rows.drop("batch_id").write.parquet(f"{workdir}/log/batch_id=0")
    assert _state(spark, f"{workdir}/log") == [("d1", "t1", 2.0, 1.5), ("d2", "t1", 7.0, 1.5)]
    assert read_log(spark, f"{workdir}/log").where("_arrival_time IS NOT NULL").count() == 0


def test_keyed_state_equals_the_log(spark, workdir):
    src, table = f"{workdir}/src", _lake(spark, f"{workdir}/lake", buckets=2)
    put = lambda: start_keyed_state(table, spark, f"{src}/*", f"{workdir}/ck").awaitTermination()
    state = lambda: sorted(tuple(r) for r in table.read().select(*KEYS, "temperature", "humidity").collect())
    _write(spark, f"{src}/a1", [_msg("d1", "t1", 10.0), _msg("d1", "t1", 11.0), _msg("d2", "t1", 5.0), "nope", ""])
    put()
    assert state() == [("d1", "t1", 11.0, 1.5), ("d2", "t1", 5.0, 1.5)]
    first = table.mark("state")
    _write(spark, f"{src}/a2", [_msg("d1", "t1", None), _msg("d3", "t1", 1.0)])
    put()
    assert state() == [("d1", "t1", None, 1.5), ("d2", "t1", 5.0, 1.5), ("d3", "t1", 1.0, 1.5)]
    assert table.mark("state") > first
    start_ingest(spark, f"{src}/*", f"{workdir}/log", f"{workdir}/ck2").awaitTermination()
    assert state() == _state(spark, f"{workdir}/log")
