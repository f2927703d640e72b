from pyspark.sql import functions as F

from telemetra.functions.attributes import flatten_attrs, tagged_long_attrs, to_item, unwrap_item
from telemetra.functions.messages import parse_messages, split_rejects


def test_attribute_types_are_tagged(spark):
    doc = '{"a":true,"b":1.5,"c":"x","d":null,"e":1,"f":{"g":1},"h":28.0}'
    df = spark.createDataFrame([(1, doc)], "id int, doc string")
    out = {r["attribute"]: (r["tag"], r["value"]) for r in tagged_long_attrs(df, ["id"], F.try_parse_json("doc")).collect()}
    assert out == {
        "a": ("BOOL", "true"),
        "b": ("N", "1.5"),
        "c": ("S", "x"),
        "e": ("N", "1"),
        "f": ("S", '{"g":1}'),
        "h": ("N", "28.0"),
    }


def test_items_round_trip(spark):
    df = spark.createDataFrame([("d1", "2024-01-01T00:00:00", 21.5, None, True)], "device_id string, timestamp string, temperature double, humidity double, ok boolean")
    item = df.select(to_item(df).alias("item"))
    raw = item.collect()[0]["item"]
    assert set(raw) == {"device_id", "timestamp", "temperature", "ok"}  # NULL attribute absent
    assert raw["temperature"]["N"] == "21.5" and raw["ok"]["BOOL"] is True and raw["device_id"]["S"] == "d1"
    plain = item.select(unwrap_item(F.col("item")).alias("m")).collect()[0]["m"]
    assert plain == {"device_id": "d1", "timestamp": "2024-01-01T00:00:00", "temperature": "21.5", "ok": "true"}


def test_flatten_keeps_unknown_attributes_in_extras(spark):
    df = spark.createDataFrame([({"temperature": "1.5", "color": "red"},)], "m map<string,string>")
    r = df.select(*flatten_attrs(F.col("m"), ["temperature", "pressure"])).collect()[0]
    assert r["temperature"] == 1.5 and r["pressure"] is None and r["extras"] == {"color": "red"}


def test_bad_messages_go_to_rejects(spark):
    bodies = [
        '{"device":"d1","timestamp":"t1","data":{"temperature":20.5,"humidity":null}}',
        "nope",
        '{"device":"d1","data":{}}',
        '{"timestamp":"t","data":{}}',
        '{"device":"d1","timestamp":"t2"}',
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    good, rejects = split_rejects(parse_messages(df, keep=("id",)))
    g = good.collect()
    assert [r["id"] for r in g] == [0] and g[0]["data"] == {"temperature": "20.5"}
    reasons = {r["id"]: r["reason"] for r in rejects.collect()}
    assert reasons == {1: "malformed_json", 2: "missing_timestamp", 3: "missing_device", 4: "missing_data"}


def test_where_once_filters_without_reparsing(spark):
    from telemetra.functions.evaluation import where_once

    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',), ("bad",)], "body string")
    parsed = df.select(F.try_parse_json("body").alias("j")).select(F.try_variant_get("j", "$.a", "int").alias("a"), "j")
    kept = where_once(parsed, F.col("j").isNotNull() & (F.col("a") > 1))
    assert [r["a"] for r in kept.collect()] == [2]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
