"""Every operator query that SQL can express, against DuckDB on small driver tables."""

import os

import duckdb
import pytest

from nearcast.llm.queries import ORACLE, QUERIES
from nearcast.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted((tuple(r) for r in got.select(columns).collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
