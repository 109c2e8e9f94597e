"""Every registered query against its SQL on DuckDB, over whole small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from variloom.plans import RUNS
from variloom.plans.bridge import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


#: Plan nodes no query may need.
UNWANTED = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.mark.parametrize("name", list(RUNS))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [n for n in UNWANTED if n in plan] == []
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
