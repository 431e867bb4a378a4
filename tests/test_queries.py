import glob
import os

import duckdb
import pytest

import __spark_entry__

CORE = {k: v for k, v in __spark_entry__.catalog.QUERIES.items() if k in __spark_entry__.catalog.ORACLE_SQL}


def _plain(value):
    if value is None or value != value:
        return None
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(CORE))
def test_against_sql(spark, sf, duck, name):
    got = CORE[name](spark, sf)
    want = duck.execute(__spark_entry__.catalog.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda data: sorted(repr([_plain(v) for v in r]) for r in data)
    assert rows(got.select(*columns).collect()) == rows(want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
