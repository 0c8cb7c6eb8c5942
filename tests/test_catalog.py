"""Registered queries against their SQL on the small generated tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from staffcast.catalog.oracle import all_statements
from staffcast.catalog.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables not present")
WITHOUT_SQL = {"stl_daily_forecast", "sarima_daily_forecast", "backlog_stl_forecast", "workload_with_fits"}


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    return None if isinstance(value, float) and math.isnan(value) else value


def ordered(rows, columns):
    place = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


def test_every_query_has_sql_or_is_a_fit():
    assert set(all_queries()) - set(all_statements()) == WITHOUT_SQL
    assert set(all_statements()) <= set(all_queries())
    assert all_queries().items() <= contract.queries().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(all_statements()))
def test_same_rows_as_sql(spark, database, name):
    got = contract.queries()[name](spark, FOLDER)
    result = database.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert ordered(got.collect(), got.columns) == ordered(result.fetchall(), columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


LARGER = "/root/testdata/sf0.01"
TIES = ("agent_capacity", "capacity_consolidation", "capacity_consolidation_plain")


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="generated tables not present")
@pytest.mark.parametrize("partitions", ["3", "64"])
@pytest.mark.parametrize("name", TIES)
def test_ties_round_alike_however_rows_are_dealt(spark, name, partitions):
    con = duckdb.connect()
    for file in os.listdir(LARGER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{LARGER}/{file}'")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        got = contract.queries()[name](spark, LARGER)
        rows = ordered(got.collect(), got.columns)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    result = con.execute(contract.oracle_sql()[name])
    assert rows == ordered(result.fetchall(), [c[0] for c in result.description])


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL - {"workload_with_fits"}))
def test_fitted_bands(spark, name):
    rows = contract.queries()[name](spark, FOLDER).collect()
    assert rows
    for r in rows:
        assert None not in (r.p05, r.p50, r.p95) and 0 <= r.p05 <= r.p50


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "Expected Workload vs Capacity" in df.columns
