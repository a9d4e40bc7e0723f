"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores. The
stored tables (landed raw data, dimensions, product statistics) are built first
and reported as ``setup``, which the total includes; every query is then run once
in full, writing to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from ledgerlens.plans import dimensions, stats
from ledgerlens.session import build_session
from ledgerlens.workload import registry
from ledgerlens.workload.driver_tables import RAW_SQL, warehouse
from ledgerlens.workload.model_queries import MODELS

HEADLINE = [
    "model_daily_revenue_summary",
    "model_api_revenue_summary",
    "model_harvests",
    "model_harvest_hourly",
    "model_unified_hourly",
    "model_product_stats",
    "model_product_stats_latest",
    "model_chain_stats",
    "model_product_tvl_diff",
    "model_investor_timeline_recent",
    "model_zap_activity",
    "model_account",
    "join_asof_left",
    "coalesce_merge",
    "dedup_latest",
    "agg_last_by_time",
    "agg_quantiles",
    "agg_collect_if_sorted",
    "agg_multi_source_daily",
    "join_point_lookup",
    "win_global_rank",
    "upsert_delete_insert",
    "stream_hourly_last",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "ledgerlens-bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    setup: dict[str, float] = {}

    began = time.perf_counter()
    w = warehouse(spark, sf_dir)
    for name in RAW_SQL:
        w.table(name)
    setup["landed_raw_tables"] = round(time.perf_counter() - began, 3)
    began = time.perf_counter()
    for build in (dimensions.product, dimensions.token, dimensions.account, stats.product_stats):
        w.model(build)
    setup["stored_tables"] = round(time.perf_counter() - began, 3)

    queries = registry.queries()
    for name in HEADLINE:
        model = MODELS.get(name.removeprefix("model_"))
        began = time.perf_counter()
        # Models are timed as they would be written, without the rounding that
        # only serves comparison.
        rows = model.build(w.at(model.as_of)) if model else queries[name](spark, sf_dir)
        rows.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()) + sum(setup.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup": setup,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
