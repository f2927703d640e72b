from pyspark.sql import functions as F

from telemetra.streaming.ingest import latest_items, read_log, rejected_messages, start_ingest


def _write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def _msg(dev, ts, t):
    t = "null" if t is None else t
    return f'{{"device":"{dev}","timestamp":"{ts}","data":{{"temperature":{t},"humidity":1.5,"color":"red"}}}}'


def _state(spark, log):
    return sorted(tuple(r) for r in latest_items(spark, log).select("device_id", "timestamp", "temperature", "humidity").collect())


def test_last_arrival_wins_and_rejects_are_kept(spark, workdir):
    src, log, ck = f"{workdir}/src", f"{workdir}/log", f"{workdir}/ck"
    _write(spark, f"{src}/a1", [_msg("d1", "t1", 10.0), _msg("d1", "t1", 11.0), _msg("d2", "t1", 5.0), "nope"])
    start_ingest(spark, f"{src}/*", log, ck).awaitTermination()
    assert _state(spark, log) == [("d1", "t1", 11.0, 1.5), ("d2", "t1", 5.0, 1.5)]
    _write(spark, f"{src}/a2", [_msg("d1", "t1", None)])
    start_ingest(spark, f"{src}/*", log, ck).awaitTermination()
    # whole-row replace: the later message's missing reading is NULL
    assert _state(spark, log) == [("d1", "t1", None, 1.5), ("d2", "t1", 5.0, 1.5)]
    assert [r["reason"] for r in rejected_messages(spark, log).collect()] == ["malformed_json"]
    extras = latest_items(spark, log).select("extras").collect()[0]["extras"]
    assert extras == {"color": "red"}


def test_one_file_many_files_and_replay_agree(spark, workdir):
    lines = [_msg(f"d{i % 3}", f"t{i % 7}", float(i)) for i in range(60)]
    one, many = f"{workdir}/one", f"{workdir}/many"
    _write(spark, f"{one}/src/a", lines)
    for i in range(0, 60, 20):
        _write(spark, f"{many}/src/a{i:03d}", lines[i : i + 20])
    start_ingest(spark, f"{one}/src/*", f"{one}/log", f"{one}/ck").awaitTermination()
    start_ingest(spark, f"{many}/src/*", f"{many}/log", f"{many}/ck", max_files_per_trigger=1).awaitTermination()
    a, b = _state(spark, f"{one}/log"), _state(spark, f"{many}/log")
    assert a == b and len(a) == 21
    before = read_log(spark, f"{one}/log").count()
    # a replay without the checkpoint rewrites batch 0 with the same rows
    start_ingest(spark, f"{one}/src/*", f"{one}/log", f"{one}/ck2").awaitTermination()
    assert read_log(spark, f"{one}/log").count() == before
    assert _state(spark, f"{one}/log") == a


def test_fold_into_lake_equals_the_key_view(spark, workdir):
    import uuid

    from telemetra.sinks.lake import LakeTable
    from telemetra.streaming.ingest import fold_log

    src, log, ck = f"{workdir}/src", f"{workdir}/log", f"{workdir}/ck"
    _write(spark, f"{src}/a1", [_msg("d1", "t1", 1.0), _msg("d2", "t1", 2.0), "nope"])
    start_ingest(spark, f"{src}/*", log, ck).awaitTermination()
    table = LakeTable(spark, f"{workdir}/lake", f"items_{uuid.uuid4().hex[:8]}", ("device_id", "timestamp"), ("device_id",))
    assert fold_log(table, spark, log) == 0
    _write(spark, f"{src}/a2", [_msg("d1", "t1", 9.0), _msg("d3", "t2", 3.0)])
    start_ingest(spark, f"{src}/*", log, ck).awaitTermination()
    assert fold_log(table, spark, log, after_batch=0) == fold_log(table, spark, log, after_batch=1) == 1
    lake = sorted(tuple(r) for r in table.read().select("device_id", "timestamp", "temperature", "humidity").collect())
    assert lake == _state(spark, log) == [("d1", "t1", 9.0, 1.5), ("d2", "t1", 2.0, 1.5), ("d3", "t2", 3.0, 1.5)]


def test_mixed_types_are_kept_with_their_tag_and_other_topics_left_out(spark, workdir):
    src, log, ck = f"{workdir}/src", f"{workdir}/log", f"{workdir}/ck"
    mixed = '{"device":"d1","timestamp":"t1","data":{"temperature":"zz","humidity":true,"pressure":28.0,"n":7,"o":{"g":1},"x":null}}'
    _write(spark, f"{src}/a1", [mixed, '{"device":"d2","timestamp":"t1","data":{"temperature":"21.5"}}'])
    _write(spark, f"{src}/topic=other", [_msg("d9", "t1", 1.0)])
    _write(spark, f"{src}/topic=telemetry_data", [_msg("d3", "t1", 1.0)])
    start_ingest(spark, f"{src}/*", log, ck).awaitTermination()
    rows = {r.device_id: r for r in latest_items(spark, log).collect()}
    assert sorted(rows) == ["d1", "d2", "d3"]
    r = rows["d1"]
    assert (r.temperature, r.humidity, r.pressure) == (None, None, 28.0)
    assert r.extras == {"temperature": "zz", "humidity": "true", "n": "7", "o": '{"g":1}'}
    tagged = {k: {t: x for t, x in v.asDict().items() if x is not None} for k, v in r.item.items()}
    assert tagged == {"temperature": {"S": "zz"}, "humidity": {"BOOL": True}, "pressure": {"N": "28.0"}, "n": {"N": "7"}, "o": {"S": '{"g":1}'}}
    assert rows["d2"].temperature == 21.5 and rows["d2"].extras == {}
