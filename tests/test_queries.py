import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def plain(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else [plain(x) for x in v] if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted(repr([plain(v) for v in r]) for r in got.select(*columns).collect())
    assert a == sorted(repr([plain(v) for v in r]) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
