"""Every registered query against its DuckDB oracle, on the smallest data."""

import duckdb
import pytest

from oracles import all_oracles
from tonearm.registry import all_queries
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = all_queries(), all_oracles()
LONG = {"run_load_plan", "stream_stage", "stream_vault"}  # covered by test_stream on small input


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, result.fetchall())
