"""Merged re-crawl and partitioned registration."""

import itertools
import uuid

import pytest

from telemetra.operators import infer
from telemetra.operators.infer import BIGINT, BOOLEAN, DATE, DOUBLE, STRING, VOID, crawl, folder_columns, merge_columns, merge_types, registered_columns

TYPES = [VOID, BOOLEAN, DATE, BIGINT, DOUBLE, STRING]


@pytest.fixture
def name(spark, workdir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS telemetra_c LOCATION '{workdir}/db'")
    return f"telemetra_c.crawled_{uuid.uuid4().hex[:8]}"


def _lines(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def _rows(spark, name, *columns):
    return sorted((tuple(r) for r in spark.table(name).select(*columns).collect()), key=str)


def test_types_are_a_lattice():
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert merge_types(a, a) == a and merge_types(a, b) == merge_types(b, a)
        assert merge_types(merge_types(a, b), c) == merge_types(a, merge_types(b, c))
        assert merge_types(a, VOID) == a and merge_types(a, STRING) == STRING
    assert merge_types(BIGINT, DOUBLE) == DOUBLE and merge_types(BOOLEAN, BIGINT) == STRING


def test_merged_columns_keep_their_place_and_case_clashes_fail():
    assert list(merge_columns({"z": BIGINT, "b": VOID}, {"a": STRING, "z": DOUBLE, "b": DATE}).items()) == [("z", DOUBLE), ("b", DATE), ("a", STRING)]
    with pytest.raises(ValueError):
        merge_columns({"a": BIGINT}, {"A": BIGINT})


def test_a_second_crawl_widens_and_adds(spark, workdir, name):
    _lines(spark, f"{workdir}/r", '{"a": 1, "n": null, "t": true, "gone": 5}')
    crawl(spark, name, f"{workdir}/r")
    assert dict(spark.table(name).dtypes) == {"a": "bigint", "gone": "bigint", "n": "string", "t": "boolean"}
    old = spark.table(name)
    _lines(spark, f"{workdir}/r", '{"a": 1.5, "b": "x", "n": 7, "t": 3, "o": {"k": [1]}}')
    crawl(spark, name, f"{workdir}/r")
    assert spark.table(name).dtypes == [("a", "double"), ("gone", "bigint"), ("n", "bigint"), ("t", "string"), ("b", "string"), ("o", "string")]
    assert _rows(spark, name, "a", "b", "n", "t", "o", "gone") == [(1.0, None, None, "true", None, 5), (1.5, "x", 7, "3", '{"k": [1]}', None)]
    assert [r.a for r in old.collect()] == [1]  # a reader of the old schema goes on
    # nothing new: the same table behind the view; new files are found all the same
    behind = infer._crawled_table(spark, name)
    _lines(spark, f"{workdir}/r", '{"a": 4}')
    crawl(spark, name, f"{workdir}/r")
    assert infer._crawled_table(spark, name) == behind and spark.table(name).count() == 3
    assert [r.tableName for r in spark.sql("SHOW TABLES IN telemetra_c").collect() if name.split(".")[1] in r.tableName and "__" in r.tableName] == [behind.split(".")[1]]


def test_types_never_narrow(spark, workdir, name):
    _lines(spark, f"{workdir}/a", '{"x": 1.5, "y": "t"}')
    crawl(spark, name, f"{workdir}/a")
    _lines(spark, f"{workdir}/b", '{"x": 1}')
    crawl(spark, name, f"{workdir}/b")
    assert registered_columns(spark, name) == {"x": DOUBLE, "y": STRING}


def test_field_limit_fails(spark, workdir, name):
    _lines(spark, f"{workdir}/r", '{"a": 1, "b": 2, "c": 3}')
    with pytest.raises(ValueError, match="more than 2 fields"):
        crawl(spark, name, f"{workdir}/r", max_fields=2)


def test_partition_folders_are_registered_with_their_types(spark, workdir, name):
    days = ["2024-01-01", "2024-02-30x"]
    rows = [('{"v": %d}' % i, None if i % 4 == 0 else f"0{i % 3}", i % 2, "a+b/c d%:=x" if i == 3 else "p", "2024-01-0%d" % (i % 3 + 1)) for i in range(10)]
    frame = spark.createDataFrame(rows, "value string, code string, n int, s string, day string")
    frame.write.partitionBy("code", "n", "s", "day").text(f"{workdir}/p")
    assert folder_columns(spark, f"{workdir}/p") == {"code": STRING, "n": BIGINT, "s": STRING, "day": DATE}
    crawl(spark, name, f"{workdir}/p")
    got = sorted((r.v, r.code, r.n, r.s, str(r.day)) for r in spark.table(name).collect())
    assert got == sorted((i, *x[1:]) for i, x in enumerate(rows))
    plan = spark.table(name).where("n = 1 AND code = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan
    # a new folder widens its column; the other folders are found again
    for k, day in enumerate(days):
        spark.createDataFrame([('{"v": 99, "n": 5}', "01", "x0", "p", day)], frame.schema.simpleString()[7:-1].replace("n:int", "n:string").replace(":", " ")).write.mode("append").partitionBy("code", "n", "s", "day").text(f"{workdir}/p")
    crawl(spark, name, f"{workdir}/p")
    assert dict(spark.table(name).dtypes) == {"v": "bigint", "code": "string", "n": "string", "s": "string", "day": "string"}
    assert spark.table(name).count() == 12 and spark.table(name).where("n = 'x0'").count() == 2


def test_partition_columns_given_must_be_the_folders(spark, workdir, name):
    spark.range(3).selectExpr("'{}' AS value", "id AS p").write.partitionBy("p").text(f"{workdir}/p")
    fields = infer.inferred_fields(spark.createDataFrame([('{"a": 1}',)], "j string"), "j")
    infer.register_inferred_table(spark, fields, name, f"{workdir}/p", partition_by=("p",), fmt="json")
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError):
        infer.register_inferred_table(spark, fields, name, f"{workdir}/p", partition_by=("q",), fmt="json")
    _lines(spark, f"{workdir}/p/q=1", "{}")
    with pytest.raises(ValueError, match="different partition columns"):
        folder_columns(spark, f"{workdir}/p")


def test_folders_above_the_location_are_no_columns(spark, workdir):
    spark.range(2).selectExpr("'{}' AS value", "id AS p").write.partitionBy("p").text(f"{workdir}/x=1/data")
    assert folder_columns(spark, f"{workdir}/x=1/data/") == {"p": BIGINT}
    assert folder_columns(spark, f"{workdir}/nowhere") == {}
