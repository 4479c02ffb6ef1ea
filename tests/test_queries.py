"""Every registered query against its oracle, and the shape of the plans."""

import pytest

import __spark_entry__ as driver
from meseta.workload import registry
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
# the queries of the training-data package have tests of their own
QUERIES, ORACLES = dict(registry.QUERIES), dict(registry.ORACLES)


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, connection, name):
    assert differences(spark, connection, FOLDER, name, QUERIES[name], ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0


STORED = {
    "landing_envelopes", "landing_text", "landing_csv", "upsert_result", "backfill_range", "backfill_untouched",
    "geography_fix", "incremental_silver", "upsert_unpartitioned", "table_upsert", "table_layout", "gold_incremental", "stream_upsert", "stream_dedup",
    "upsert_bucketed", "upsert_unpublished", "stored_window", "load_silver_all", "load_modes", "bronze_readers", "indicator_scan",
    "load_gold_windows", "key_combinations"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["window_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
