"""Wide marts move narrow rows once, sort them after that, and read raw harvests where they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import merge, rollup
from ledgerlens.session import WIDE, ensure_wide
from ledgerlens.workload import driver_tables

SMALL = "/root/testdata/sf0.001"
VALUES = ["a", "b", "tags", "c", "alone"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sparse(spark):
    rows = [
        (1, 10, "x", 1, None, None, None, None),
        (1, 10, "y", None, None, ["t"], 2.5, None),
        (1, 10, "z", None, None, None, None, 7),
        (1, 11, "y", None, None, [], None, None),
        (2, 10, "x", None, 4, None, None, None),
    ]
    return spark.createDataFrame(rows, "k int, h int, source string, a int, b int, tags array<string>, c double, alone int")


def test_packed_fold_equals_the_plain_one(spark):
    sparse = _sparse(spark)
    plain = merge.coalesce_merge(sparse, ["k", "h"], VALUES)
    packed = merge.coalesce_merge(sparse, ["k", "h"], VALUES, together=[["a", "b"], ["tags", "c"]])
    assert packed.dtypes == plain.dtypes
    assert sorted(packed.collect()) == sorted(plain.collect())
    # Three structs or values a row travel, not five.
    assert _plan(packed).count("max(_pack") >= 3 and "_pack3" not in _plan(packed)


def test_rows_are_sorted_after_they_moved(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 7).alias("k"),
        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("ts"),
        F.col("id").cast("decimal(38,18)").alias("v"),
    )
    for combined, moved in (
        (rollup.hourly_last(rows, ["k"], "ts", {"v": "v"}), rollup.hourly_last(rows, ["k"], "ts", {"v": "v"}, combine=False)),
        (merge.dedup_latest(rows, ["k"], ["ts"]), merge.dedup_latest(rows, ["k"], ["ts"], combine=False)),
    ):
        assert sorted(moved.collect()) == sorted(combined.collect())
        # Upper lines of a plan come first: a sort is above the only shuffle, none below it.
        above, _, below = _plan(moved.select("*")).split("== Initial Plan ==")[-1].partition("Exchange")
        assert "Sort" in above and "Sort" not in below and "Exchange" not in below


def test_raw_harvests_are_read_where_they_are(spark):
    w = driver_tables.warehouse(spark, SMALL)
    assert all(SMALL in path for path in w.table("db_harvests").inputFiles())


def test_settings_of_the_session_are_kept(spark):
    key = "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3.0")
        assert ensure_wide(spark).conf.get(key) == "3.0"
        spark.conf.set(key, "1.0")
        assert ensure_wide(spark).conf.get(key) == WIDE[key]
    finally:
        spark.conf.set(key, before)
