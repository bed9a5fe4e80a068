"""Every registered query against its SQL, row by row, over whole tables."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from __spark_entry__ import entry, oracle_sql, queries
from daybook.queries import ORACLE_SQL, QUERIES, inputs
from daybook.schemas import USER_ACTIVITY_SUMMARY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]

# Spark type -> the SQL engine's name for it.
SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _sorted_rows(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLE_SQL.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE_SQL[name])
    columns = sorted(actual.columns)
    assert columns == sorted(expected.columns)
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in actual.schema} == dict(
        zip(expected.columns, map(str, expected.types))
    )
    expected_rows = expected.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    actual_rows = [tuple(row) for row in actual.select(*columns).collect()]
    assert expected_rows
    assert _sorted_rows(actual_rows) == _sorted_rows(expected_rows)


def test_entry(spark):
    summary = entry(spark)
    assert summary.columns == USER_ACTIVITY_SUMMARY.names
    assert summary.count() > 0


def test_the_planted_cases_occur(spark):
    """Each awkward case of the inputs, where the results above depend on it."""
    sf_dir = "/root/testdata/sf0.01"
    events, bought, users = (
        f(spark, sf_dir) for f in (inputs.user_events, inputs.purchases, inputs.lookup_user)
    )
    for df, cases in (
        (events, ["event_timestamp", "event_type", "session_id", "user_id"]),
        (bought, ["transaction_id", "user_id", "is_refunded"]),
        (users, ["age_group", "subscription_tier"]),
    ):
        for name in cases:
            assert 0 < df.where(f"{name} IS NULL").count() < df.count() / 2
    assert events.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert bought.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    active = users.where("is_active")
    each = active.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct(F.coalesce("subscription_tier", F.lit(""))).alias("tiers")
    )
    assert {(r.n, r.tiers) for r in each.select("n", "tiers").distinct().collect()} == {(1, 1), (2, 1), (2, 2)}
    assert users.join(bought, "user_id", "left_anti").count() > 0
    summary = QUERIES["user_activity_summary"](spark, sf_dir)
    repeated = summary.groupBy("user_id", "partition_date").count().where("count > 1")
    assert repeated.count() > 0
    for case in ("total_purchases = 0", "username = 'unknown'", "subscription_tier = 'free'"):
        assert summary.where(case).count() > 0


def test_the_job_prunes_its_stored_inputs(spark):
    """Events and purchases of the job's query are read by date."""
    read = QUERIES["snk_partitioned_pruned_read"](spark, SF_DIR)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in text
    assert "InMemoryFileIndex(16 paths)" in text


def test_results_have_the_declared_types(spark):
    summary = QUERIES["user_activity_summary"](spark, SF_DIR)
    for field, declared in zip(summary.schema, USER_ACTIVITY_SUMMARY):
        if isinstance(declared.dataType, T.TimestampType):
            assert isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))
        else:
            assert field.dataType == declared.dataType


WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
from daybook.queries import ORACLE_SQL, QUERIES
assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLE_SQL
"""


@pytest.mark.parametrize("missing", ["corpus_pipeline", "daybook.llm", "public_tokenizers"])
def test_the_entry_works_without_the_optional_part(missing):
    root = Path(__file__).resolve().parents[1]
    code = WITHOUT.format(missing=missing)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
