"""The queries with SQL against DuckDB on the driver's smallest tables."""

import os

import duckdb
import pytest

from mosaicflow.llm.entry import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SMALL}/{f}'")
    got = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    ours = sorted(([r[c] for c in sorted(columns)] for r in got.collect()), key=str)
    at = [columns.index(c) for c in sorted(columns)]
    assert ours == sorted(([r[i] for i in at] for r in want.fetchall()), key=str)


def test_one_query_of_each_number():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 11))
