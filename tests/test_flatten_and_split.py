"""P5 (every attribute a column) and F6 (both outputs of one parse)."""

import pytest
from pyspark.sql import functions as F

from telemetra.functions.messages import parse_messages
from telemetra.operators.flatten import attribute_types, flatten_all
from telemetra.registry import message_bodies, telemetry
from telemetra.sinks.split import write_split

SF = "/root/testdata/sf0.001"
DOCS = [
    (1, '{"b": true, "i": 5, "d": 2, "s": "x", "m": 1.50, "o": {"g": 1}, "none": null, "a b\'c": 1, "q\\"r\'": "z"}'),
    (2, '{"b": false, "d": 28.0, "m": "t", "o": [1, null]}'),
    (3, '{"b": null, "m": true}'),
    (4, "no json"),
    (5, "[1, 2]"),
    (6, None),
    (7, "{}"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, j string")


def test_every_attribute_is_a_column_of_its_type(spark, docs):
    assert attribute_types(docs, F.try_parse_json("j")) == {"a b'c": "bigint", "b": "boolean", "d": "double", "i": "bigint", "m": "string", "o": "text", "q\"r'": "text", "s": "text"}
    flat = flatten_all(docs, "j", ["id"])
    assert flat.columns == ["id", "a b'c", "b", "d", "i", "m", "o", "q\"r'", "s"]
    rows = [tuple(r) for r in flat.orderBy("id").collect()]
    assert rows[:3] == [
        (1, 1, True, 2.0, 5, "1.5", '{"g":1}', "z", "x"),
        (2, None, False, 28.0, None, "t", "[1,null]", None, None),
        (3, None, None, None, None, "true", None, None, None),
    ]
    assert rows[3:] == [(i, *[None] * 8) for i in range(4, 8)]


def test_limits_and_clashes_fail(docs):
    with pytest.raises(ValueError, match="more than 3"):
        flatten_all(docs, "j", ["id"], max_columns=3)
    with pytest.raises(ValueError, match="prefix"):
        flatten_all(docs.withColumnRenamed("id", "B"), "j", ["B"])
    assert "data_b" in flatten_all(docs.withColumnRenamed("id", "B"), "j", ["B"], prefix="data_").columns


def test_no_attribute_at_all(spark, docs):
    assert flatten_all(docs.where("id > 3"), "j", ["id"]).columns == ["id"]


def test_body_is_parsed_once(docs):
    plan = flatten_all(docs, "j", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_split_writes_both_outputs_from_one_scan(spark, workdir):
    scans = spark.sparkContext.accumulator(0)
    tele = telemetry(spark, SF)
    parsed = parse_messages(message_bodies(tele), keep=("event_id",))
    want = {r.reason or "good": r["count"] for r in parsed.groupBy("reason").count().collect()}

    def seen(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    split = write_split(parsed.drop("data").mapInArrow(seen, parsed.drop("data").schema), f"{workdir}/split")
    assert scans.value == sum(want.values()) == tele.count()
    assert {k: n for k, n in split.counts.items() if n} == want and split.counts["other"] == 0
    assert split.good.count() == want["good"] and "reason" not in split.good.columns
    assert {r.reason: r["count"] for r in split.rejects.groupBy("reason").count().collect()} == {k: n for k, n in want.items() if k != "good"}
    assert "__valid=true" in split.good.inputFiles()[0] and scans.value == sum(want.values())
    plan = split.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan


def test_split_without_rejects_and_with_other_reasons(spark, workdir):
    rows = spark.createDataFrame([(1, None), (2, "odd")], "id int, reason string")
    split = write_split(rows, f"{workdir}/a")
    assert split.counts["good"] == split.counts["other"] == 1
    good = write_split(rows.where("id = 1"), f"{workdir}/b")
    assert good.rejects.count() == 0 and good.good.count() == 1
    assert sum(write_split(rows.limit(0), f"{workdir}/c").counts.values()) == 0
