"""Marts of recent rows bound the rollups they come from."""

from __future__ import annotations

from ledgerlens.plans import stats
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, RAW_SQL, raw_table
from ledgerlens.sources.catalog import Warehouse

SMALL = "/root/testdata/sf0.001"


def test_recent_marts_do_not_store_all_product_statistics(spark):
    raw = {name: (lambda session, name=name: raw_table(session, SMALL, name)) for name in RAW_SQL}
    w = Warehouse(spark, EVENTS_AS_OF, raw)
    latest, diff = stats.product_stats_latest(w), stats.product_tvl_diff(w)
    assert not any(key.endswith(".product_stats") for key in w._tables)
    # The bound is found beneath the first shuffle of the largest source.
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Filter" in line and "l_shipdate" in line]
    assert scans and all("date_trunc" in line or "2024-01-16" in line for line in scans)
    whole = w.model(stats.product_stats)
    assert w.part(stats.product_stats) is whole
    again = stats.product_stats_latest(w)
    assert sorted(map(str, latest.collect())) == sorted(map(str, again.collect()))
    assert diff.count() == latest.count()
