"""Every registered query against its SQL twin in DuckDB on the smallest tables."""

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_points
from clickloom import catalog

# Python in the plan, and joins without an equality
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")

QUERIES, SQL = catalog.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    yield connection
    connection.close()


def test_names_agree():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    theirs = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    assert mine == theirs


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r["platform"] for r in rows} == {"Desktop", "Mobile", "Tablet"}
