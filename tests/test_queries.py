"""Every registered query against its SQL twin, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from given import SMALL
from wayfare import oracles
from wayfare import queries as registered

TABLES = ("lineitem", "orders", "part", "events")
QUERIES, SQL = registered.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return connection


def plain(rows):
    return sorted(tuple(v.isoformat() if hasattr(v, "isoformat") else repr(v) for v in row) for row in rows)


def test_every_query_has_its_statement():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_statement(spark, duck, name):
    ours = QUERIES[name](spark, SMALL)
    columns = sorted(ours.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = duck.execute(f"SELECT {listed} FROM ({SQL[name]})").fetchall()
    got = [tuple(row) for row in ours.select(*columns).collect()]
    assert got, "a query over the given tables finds something"
    assert plain(got) == plain(theirs)


def test_entry(spark):
    top = entry.entry(spark)
    assert top.columns == ["route", "transport_type", "total_revenue"] and top.count() == 10


WRITING = ("stream_", "loads_", "delta_", "landing_", "audience_", "sink_")
LAZY = [name for name in QUERIES if not name.startswith(WRITING) and name not in ("dq_model_tests", "dq_history", "dlq_after_replay", "dlq_lifecycle", "dlq_after_recovery")]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_jvm_and_have_no_cross_product(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan


def plan_of(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_conversion_reads_the_events_once_per_branch(spark):
    assert plan_of(spark, "mart_booking_conversion_events").count("FileScan") == 2  # the two branches of the raw union


def test_checks_read_the_table_once(spark):
    assert plan_of(spark, "dq_orders").count("FileScan") == 1


def test_high_water_mark_reaches_the_scan(spark):
    query = QUERIES["incremental_bookings"](spark, SMALL)._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(query, "formatted")
    assert "GreaterThan(l_shipdate,ScalarSubquery" in plan


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan_of(spark, "events_outcome_5m")
