"""A spread of registered queries against their SQL answers at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from ledgerlens.workload import registry

SF = "/root/testdata/sf0.001"
SPREAD = [
    "model_daily_revenue_summary",
    "model_product_tvl_diff",
    "model_investor_timeline",
    "model_zap_activity",
    "model_account",
    "model_missing_products_in_index",
    "staging_db_harvests",
    "staging_api_clm_vaults",
    "join_asof_left",
    "coalesce_merge",
    "agg_quantiles_large_groups",
    "upsert_delete_insert",
    "stream_hourly_last",
    "src_json_map3",
    "dq_relationship_array_multi",
]


def test_every_query_has_an_answer():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SPREAD)
def test_query_agrees(spark, con, name):
    problem, _, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert problem is None


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_no_single_task_or_cross_join_in_plans(spark):
    for name in ("model_product_tvl_diff", "join_asof_left", "join_const", "model_zap_activity"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "SinglePartition" not in plan, name
