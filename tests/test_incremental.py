"""Models kept as tables: runs from stored thresholds."""

from __future__ import annotations

import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.filters import unlike_stored
from ledgerlens.plans import incremental, investor, stats
from ledgerlens.plans.incremental import DERIVED, INCREMENTAL, run_chain, run_incremental, run_timeline, run_until, stored_rows
from ledgerlens.sinks.versions import current_version, read_version
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, warehouse, warehouse_at

SMALL = "/root/testdata/sf0.001"


def test_the_bound_reaches_the_scan(spark):
    w = warehouse(spark, SMALL)
    plan = stats.tvl_hourly(w, datetime(2024, 1, 10))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(t,", plan)


def test_runs_equal_one_build_and_repeat_harmlessly(spark, tmp_path):
    w, path = warehouse(spark, SMALL), str(tmp_path / "tvl")
    model = INCREMENTAL["tvl_hourly"]
    times = [datetime(2024, 1, 9), datetime(2024, 1, 20), datetime(2100, 1, 1), datetime(2100, 1, 1)]
    rows = run_until(w, model, path, times)
    assert current_version(spark, path).number == len(times)
    whole = stats.tvl_hourly(w)
    assert sorted(map(tuple, rows.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert run_incremental(w.at(datetime(2100, 1, 1)), model, path) == len(times) + 1


def rows_of(df, columns=None):
    return Counter(map(str, df.select(*(columns or df.columns)).collect()))


def test_changes_go_from_model_to_model(spark, tmp_path):
    root = str(tmp_path)
    runs = [datetime(1996, 1, 1), datetime(2024, 1, 10), datetime(2024, 1, 11), datetime(2024, 2, 2), datetime(2024, 2, 2)]
    counts = [run_chain(warehouse_at(spark, SMALL, at), root) for at in runs]
    assert all(counts[0].values()) and not any(counts[-1].values())
    # A day later little has changed, late rows among it, and little is recomputed.
    assert 0 < counts[2]["unified_hourly"] < counts[1]["unified_hourly"] / 20
    w = warehouse(spark, SMALL)
    for name, build in (("unified_hourly", stats.unified_hourly), ("product_stats", stats.product_stats), ("chain_stats", stats.chain_stats)):
        whole = build(w)
        assert rows_of(stored_rows(w, f"{root}/{name}"), whole.columns) == rows_of(whole), name


def test_a_follower_reads_changed_partitions_only(spark, tmp_path):
    root, model = str(tmp_path), DERIVED["product_stats"]
    for at in (datetime(2024, 1, 10), datetime(2024, 1, 11)):
        w = warehouse_at(spark, SMALL, at)
        incremental.run_source(w, INCREMENTAL["unified_hourly"], f"{root}/unified_hourly")
        rows, newest = incremental.changed_source(w, model, f"{root}/unified_hourly", f"{root}/product_stats")
        files = [f for f in rows.inputFiles() if "/unified_hourly/" in f]
        if newest == 1:
            incremental.run_derived(w, model, f"{root}/unified_hourly", f"{root}/product_stats")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert newest == 2 and files and len({f.split("/_part=")[1].split("/")[0] for f in files}) == 1
    assert "GreaterThanOrEqual(date_hour" in plan and "LessThanOrEqual(date_hour" in plan


def test_a_run_that_dies_before_its_progress_is_noted_repeats_itself(spark, tmp_path, monkeypatch):
    root, w, model = str(tmp_path), warehouse_at(spark, SMALL, datetime(2024, 1, 10)), DERIVED["chain_stats"]
    run_chain(w, root)
    later = warehouse_at(spark, SMALL, datetime(2024, 1, 12))
    incremental.run_source(later, INCREMENTAL["unified_hourly"], f"{root}/unified_hourly")
    incremental.run_derived(later, DERIVED["product_stats"], f"{root}/unified_hourly", f"{root}/product_stats")
    real = incremental.append_table

    def dies(rows, path):
        if path.endswith("-progress"):
            raise OSError("lost")
        real(rows, path)

    monkeypatch.setattr(incremental, "append_table", dies)
    with pytest.raises(OSError):
        incremental.run_derived(later, model, f"{root}/product_stats", f"{root}/chain_stats")
    monkeypatch.setattr(incremental, "append_table", real)
    assert incremental.run_derived(later, model, f"{root}/product_stats", f"{root}/chain_stats") == 0
    whole = stats.chain_totals(later, stored_rows(later, f"{root}/product_stats"))
    assert rows_of(stored_rows(later, f"{root}/chain_stats"), whole.columns) == rows_of(whole)


def test_unlike_stored_compares_nulls_and_arrays(spark):
    schema = "k int, a array<int>, v double"
    old = spark.createDataFrame([(1, [1], 1.0), (2, None, None), (None, [2], 5.0), (4, [], 0.5)], schema)
    new = spark.createDataFrame([(1, [1], 1.0), (2, None, None), (None, [2], 5.0), (4, None, 0.5), (5, [1], 1.0)], schema)
    assert sorted(r.k for r in unlike_stored(new, old, ["k"]).collect()) == [4, 5]


def test_timeline_windows_equal_one_run_with_carried_prices(spark, tmp_path):
    w, path = warehouse(spark, SMALL), str(tmp_path / "timeline")
    windows = 0
    while run_timeline(w, path, datetime(2023, 10, 12), carry=True):
        windows += 1
    whole = investor.priced_changes(w, datetime(2023, 10, 12), EVENTS_AS_OF - timedelta(days=7))
    got = stored_rows(w, path)
    assert windows == 4 and rows_of(got, whole.columns) == rows_of(whole)
    closing = stored_rows(w, f"{path}-closing")
    assert {r.window_end for r in closing.collect()} == {EVENTS_AS_OF - timedelta(days=7)}
    products = investor.window_prices(w, datetime(2023, 1, 1), EVENTS_AS_OF - timedelta(days=7)).select(*investor.PRICED).distinct()
    assert closing.where("chain_id is not null").count() == products.count() and closing.count() == products.count() + 1
    # Without carrying, a window knows its own prices only.
    path = str(tmp_path / "alone")
    while run_timeline(w, path, datetime(2023, 10, 12)):
        pass
    cut = datetime(2024, 1, 12)
    parts = investor.priced_changes(w, datetime(2023, 10, 12), cut).union(investor.priced_changes(w, cut, EVENTS_AS_OF - timedelta(days=7)))
    assert rows_of(stored_rows(w, path), whole.columns) == rows_of(parts)
    assert rows_of(parts) != rows_of(whole)


def test_rows_of_new_periods_are_neither_compared_nor_stored_twice(spark, tmp_path):
    from ledgerlens import session

    def publish(*rows):
        before = len(session.scratch_folders)
        df = spark.createDataFrame(rows, "k int, at string, v int").withColumn("at", F.col("at").cast("timestamp_ntz"))
        count = incremental._publish_changes(df, path, ("k", "at"), "at", "month")
        labels = [f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in session.scratch_folders[before:]]
        return count, labels

    path = str(tmp_path / "table")
    assert publish((1, "2024-01-05", 1), (2, "2024-01-06", 2)) == (2, ["batch"])
    assert publish((1, "2024-02-05", 1), (2, None, 2)) == (2, ["batch"])
    # A period that is there, one of whose rows differs, and a new one.
    assert publish((1, "2024-01-05", 1), (2, "2024-01-06", None), (2, None, 2), (3, "2024-03-01", 3)) == (2, ["batch", "changed"])
    assert publish((2, "2024-01-06", None), (3, "2024-03-01", 3)) == (0, ["batch", "changed"])
    stored = read_version(spark, path).select("k", F.col("at").cast("string"), "v").collect()
    assert sorted(map(tuple, stored), key=str) == sorted(
        [(1, "2024-01-05 00:00:00", 1), (2, "2024-01-06 00:00:00", None), (1, "2024-02-05 00:00:00", 1), (2, None, 2), (3, "2024-03-01 00:00:00", 3)], key=str
    )
