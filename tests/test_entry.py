import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from telemetra.registry import builders

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.9g}"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    try:
        if pd.isna(v):
            return ""
    except (TypeError, ValueError):
        pass
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 950
    assert df.columns == ["event_id", "device_id", "event_ts", "temperature", "pressure", "humidity"]


def test_every_query_has_an_oracle():
    missing = set(builders()) - set(entry.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(builders()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
