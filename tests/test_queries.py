"""Registered queries against their SQL on the smallest sample."""

import os

import pytest

import __spark_entry__ as contract
from meterlake import queries as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    got = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.columns, got) == ordered(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_lineage_snapshot_tells_schema_and_all_totals(spark, tmp_path):
    """Rows without priority or type are a group of the totals; a schema that a user has under the plain name stays."""
    spark.createDataFrame([("1-URGENT",), ("1-URGENT",), (None,)], "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([("click",), ("error",), (None,)], "event_type string").write.parquet(f"{tmp_path}/events.parquet")
    local = duckdb.connect()
    for table in ("orders", "events"):
        local.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    result = local.execute(contract.oracle_sql()["lineage_snapshot"])
    columns = [d[0] for d in result.description]
    spark.sql("CREATE SCHEMA sample_gold")
    try:
        df = contract.queries()["lineage_snapshot"](spark, str(tmp_path))
        got = {r.table_name: (r.table_schema, r.total_rows) for r in df.collect()}
        assert spark.catalog.databaseExists("sample_gold")
    finally:
        spark.sql("DROP SCHEMA sample_gold")
    assert got == {"orders_totals": ("sample_gold", 2), "events_totals": ("sample_gold", 3)}
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(columns, result.fetchall())
