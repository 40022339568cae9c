"""Every registered query against DuckDB on whole tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.plans import table_checks

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [p.stem for p in Path(SF_DIR).glob("*.parquet")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(table_checks.QUERIES))
def test_matches_sql(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    got = result.collect()
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_by_name(result.columns, got) == rows_by_name(columns, expected.fetchall())
    assert got


def test_every_query_has_sql():
    assert set(table_checks.QUERIES) == set(table_checks.SQL)
    assert set(table_checks.QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert len(driver.entry(spark).columns) == 59


@pytest.mark.parametrize("name", ["q_audit_wide", "q_composite_join", "q_snapshot_rotate"])
def test_matches_sql_without_broadcasts(spark, duck, name):
    """Beyond the broadcast threshold every lookup is a shuffled join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_matches_sql(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_classify_many_matches_sql_on_every_number_and_status(spark, tmp_path):
    """Order 0 with items added, and orders without a status, which the given tables lack."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT k AS o_orderkey, k AS o_custkey, s AS o_orderstatus, 1.0 AS o_totalprice, TIMESTAMP '1996-01-01' AS o_orderdate, p AS o_orderpriority
        FROM (VALUES (0), (7), (10), (4999), (5000), (49990), (123456789)) k(k), (VALUES (''), ('F'), ('O'), ('P'), ('PP')) s(s), (VALUES ('2-HIGH'), ('4-NOT SPECIFIED')) p(p))
        TO '{tmp_path}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet')")
    result = table_checks.QUERIES["q_classify_many"](spark, str(tmp_path))
    expected = con.execute(driver.oracle_sql()["q_classify_many"])
    columns = [d[0] for d in expected.description]
    assert rows_by_name(result.columns, result.collect()) == rows_by_name(columns, expected.fetchall())


def test_wide_audit_does_not_shuffle_events_for_rows_that_none_names(spark):
    """Users and models are too large to broadcast here, but not those that events name."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16384")
    try:
        wide = table_checks.QUERIES["q_audit_wide"](spark, SF_DIR)
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
