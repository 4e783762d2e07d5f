"""Physical-plan properties that matter at scale."""
import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = se.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["int_daily_stock_summary", "latest_tick_per_symbol",
                                  "stock_feature_mart", "fact_daily_features"])
def test_aggregates_stay_hash_based_with_partial_step(spark, name):
    plan = _plan(spark, name)
    assert "SortAggregate" not in plan
    assert "partial_" in plan  # map-side combine before the shuffle


def test_feature_mart_has_no_cross_product(spark):
    plan = _plan(spark, "stock_feature_mart")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["daily_stock_signals", "daily_stock_signals_enriched"])
def test_year_keyed_join_is_broadcast(spark, name):
    plan = _plan(spark, name)
    assert "BroadcastHashJoin [year(" in plan
    assert "SortMergeJoin [year(" not in plan


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(spark, "int_test_dividends")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    rollup = _plan(spark, "int_daily_stock_summary")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in rollup


def test_no_python_udfs_in_any_query_plan(spark):
    for name in ["int_daily_stock_summary", "intraday_json_parse", "kafka_record_decode",
                 "stock_feature_mart", "dq_results"]:
        plan = _plan(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
