"""Rows that are loaded again: the last load wins, whatever its values."""

from __future__ import annotations

from datetime import datetime

from ledgerlens.plans import staging, stats
from ledgerlens.workload.driver_tables import warehouse_at

AT = datetime(2024, 1, 1)
ROWS = "vault_id string, t timestamp_ntz, val double, _load_seq int"


def test_the_last_load_wins_per_key(spark):
    rows = [
        ("a", AT, 9.0, 1),
        ("a", AT, 2.0, 3),
        ("a", AT, 5.0, 2),
        ("b", AT, 7.0, 1),
        ("c", AT, 4.0, 1),
        ("c", AT, None, 2),
        ("d", AT, 1.0, 1),
        ("d", AT, 3.0, 1),
        (None, AT, 6.0, 1),
        (None, AT, 5.0, 2),
    ]
    raw = spark.createDataFrame(rows, ROWS)
    got = staging.last_loaded(raw, ["vault_id", "t"])
    assert got.columns == ["vault_id", "t", "val"]
    assert {r.vault_id: r.val for r in got.collect()} == {"a": 2.0, "b": 7.0, "c": None, "d": 3.0, None: 5.0}
    # Without load numbers the greatest columns are kept.
    plain = staging.last_loaded(raw.drop("_load_seq"), ["vault_id", "t"])
    assert {r.vault_id: r.val for r in plain.collect()} == {"a": 9.0, "b": 7.0, "c": 4.0, "d": 3.0, None: 6.0}


def test_bounds_pass_the_choice_of_the_last_load(spark):
    w = warehouse_at(spark, "/root/testdata/sf0.001", datetime(2100, 1, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2_000)
    try:
        for rows, bound in (
            (stats.tvl_hourly(w, datetime(2024, 1, 10)), "GreaterThanOrEqual(ts,2024-01-10"),
            (stats.harvest_hourly(w, datetime(2000, 1, 10)), "GreaterThanOrEqual(l_shipdate,2000-01-10"),
        ):
            assert rows._jdf.queryExecution().executedPlan().toString().count(bound) == 2  # one scan per load
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
