"""Every registered query against its SQL in DuckDB on the driver's tables."""

import math
import os
import random
from datetime import datetime

import duckdb
import numpy as np
import pytest

from mosaicflow.plans import all_queries
from tests.conftest import SF

QUERIES, SQL = all_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(f"{v:.10g}") if isinstance(v, float) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    ours, theirs = rows(got.columns, got.collect()), rows(columns, want.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def held_against_sql(spark, name, sf_dir):
    """Our rows and the SQL's, of tables in sf_dir."""
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{sf_dir}/{f}/*.parquet')")
    got, want = QUERIES[name](spark, str(sf_dir)), con.execute(SQL[name])
    return rows(got.columns, got.collect()), rows([d[0] for d in want.description], want.fetchall())


def test_array_blocks_in_single_precision(spark, tmp_path):
    """Products that reach a whole number in single precision only, and vectors with nulls or nothing in them."""
    near = [np.nextafter(np.float32(k / 100), np.float32(s)) for k in range(-99, 100) for s in (-2, 2)]
    near = [x for x in near if np.floor(x * np.float32(100)) != math.floor(float(x) * 100)]
    assert near
    vectors = [[float(x)] * 20 for x in near] + [[0.5, None, 0.25], [None], [], None]
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    ours, theirs = held_against_sql(spark, "array_blocks", tmp_path)
    assert len(ours) == len(vectors)
    assert ours == theirs


def test_frame_statistics_of_zeros(spark, tmp_path):
    """A value of zero is an observation: it lowers its cycle's mean, and a cycle of zeros alone counts."""
    r = random.Random(3)
    data = [(k, datetime(2024, 1, 1 + r.randrange(30), 12), k % 3, "ab"[k % 2], r.choice([0.0, 0.0, 0.004, 1.25, 7.5])) for k in range(300)] + [(300 + k, datetime(2024, 1, 1 + 6 * k), 9, "a", 0.0) for k in range(4)]
    spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    ours, theirs = held_against_sql(spark, "frame_statistics", tmp_path)
    assert len(ours) == 7
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(5).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_stands_without_the_training_data_operators(tmp_path):
    """Copied without those folders and the pipeline, the entry still imports and has all other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for x in ("mosaicflow", "__spark_entry__.py"):
        src = os.path.join(root, x)
        shutil.copytree(src, tmp_path / x, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(src) else shutil.copy(src, tmp_path / x)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(SQL))], out.stderr


def test_joins_are_planned_on_keys(spark):
    """No query plans a nested loop or a Cartesian product."""
    for name in QUERIES:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_names_are_worked_out_once(spark):
    for name in ("parse_names", "best_version_per_scene", "valid_footprints"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("format_string") <= 2 and plan.count("RLIKE") <= 4, (name, plan.count("format_string"), plan.count("RLIKE"))
