"""Every query runs on the smallest tables; those with SQL equal it."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from placeflow.plans.bindings import TABLES

DIR = "/root/testdata/sf0.001"
PLACES = [n for n in entry.place_queries.QUERIES if n not in ("partition_stream", "counters_stream", "grace_stream", "grace_timers", "stream_counters_log")]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def test_flagship(spark):
    assert entry.entry(spark).count() == 25


@pytest.mark.parametrize("name", PLACES)
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    rel = duck.sql(sql)
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    key = lambda cols: lambda r: tuple(repr(r[cols.index(c)]) for c in order)
    assert sorted(map(key(df.columns), rows)) == sorted(map(key(list(rel.columns)), rel.fetchall()))


def test_imports_without_the_subpackage(tmp_path):
    """A copy without the training-data folders, with and without the pipeline's file, still has all other queries."""
    root = os.path.dirname(entry.__file__)
    shutil.copytree(os.path.join(root, "placeflow"), tmp_path / "placeflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(entry.__file__, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.oracle_sql())[0])"
    for file in (None, "corpus_pipeline.py"):
        if file and os.path.exists(os.path.join(root, file)):
            shutil.copy(os.path.join(root, file), tmp_path)
        got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
        assert got.stdout.split()[0] == str(len(entry.place_queries.QUERIES))
