"""Every plan against its SQL counterpart on the smallest data."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans import PLANS

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import TABLES, rows_of  # noqa: E402
from conftest import SMALL  # noqa: E402

SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in PLANS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plan(spark, duck, name):
    df = PLANS[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows
        return
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["tbl", "count(value)", "sum(value)"] and df.count() > 0


def test_all_plans_have_a_counterpart():
    assert not set(PLANS) - set(SQL)
    assert set(PLANS) <= set(contract.queries())


def test_no_plan_meets_all_pairs(spark):
    for name in ("scan_ranges_join", "j_cdc_range", "a_flamegraph", "j_span_pair", "w_dedup_drop", "q_agg_tagged"):
        text = PLANS[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_casts_of_numbers_of_any_size(spark, tmp_path):
    users = [0, 7, 32_767, 32_768, -32_769, 90_000, 2_147_483_648, -2_147_483_649, -1, (1 << 63) - 1, 1 - (1 << 63), None]
    duckdb.execute("CREATE OR REPLACE TEMP TABLE users AS SELECT unnest(?::BIGINT[]) AS user_id", [users])
    events = duckdb.sql(
        """SELECT row_number() OVER () AS event_id, TIMESTAMP '2024-01-01 10:11:12.5' AS ts, user_id, 'view' AS event_type,
                  0.1::DOUBLE AS value, '{}' AS props FROM users"""
    )
    events.write_parquet(str(tmp_path / "events.parquet"))
    df = PLANS["x_cast_matrix"](spark, str(tmp_path))
    rows = [tuple(r) for r in df.collect()]
    cursor = duckdb.execute(SQL["x_cast_matrix"].replace("FROM events", f"FROM '{tmp_path}/events.parquet'"))
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, cursor.fetchall())
    assert {r[1] for r in rows} == {r[2] for r in rows} == set(users)
