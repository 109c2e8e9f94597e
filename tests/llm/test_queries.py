"""Registered corpus queries against their SQL on DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from variloom.llm.queries import QUERIES, SQL
from variloom.plans.bridge import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op8_chat_formatting", "op9_pii_surrogates", "op12_sharding"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Pandas", "InArrow") if n in plan]
