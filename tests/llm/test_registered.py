"""The registered queries: against SQL where it exists, and what they may not do."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from daybook.llm.oracle import ORACLE_SQL
from daybook.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
NATIVE = ("op3_exact_dedup", "op7_decontaminate", "op13_chat")


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].partition("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= queries().keys()
    assert ORACLE_SQL.items() <= oracle_sql().items() and ORACLE_SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_matches_sql(spark, name):
    with duckdb.connect() as duck:
        for table in ("documents", "benchmark", "pages", "conversations"):
            duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        actual = QUERIES[name](spark, SF_DIR)
        expected = duck.sql(ORACLE_SQL[name])
        columns = sorted(actual.columns)
        assert columns == sorted(expected.columns)
        rows = expected.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    key = lambda row: [(v is None, str(v)) for v in row]
    assert sorted((tuple(r) for r in actual.select(*columns).collect()), key=key) == sorted(rows, key=key)


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert unwanted not in text
