"""Registered queries against their SQL on the smallest tables."""

import glob
import importlib.util
import os

import duckdb
import pytest
from conftest import TESTDATA

from quireflow.plans.oracle import ORACLE
from quireflow.plans.queries import QUERIES

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows, names, columns):
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(value(r[names.index(c)]) for c in columns) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert plain([tuple(r) for r in df.collect()], df.columns, columns) == plain(cursor.fetchall(), names, columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert ("pipeline" in entry.queries()) == (importlib.util.find_spec("quireflow.llm") is not None and importlib.util.find_spec("corpus_pipeline") is not None)


def test_plans_reach_the_files(spark):
    """Filters and the columns that are used reach the scan."""
    plan = QUERIES["document_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
