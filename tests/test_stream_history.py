"""Streams told against all that is stored: late rows, repeats of any age, batches that run twice."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest

from ledgerlens.sinks.writers import append_table
from ledgerlens.streaming import history, jobs

SCHEMA = "id int, at timestamp_ntz, v double"
START = datetime(2024, 1, 1)


def hour(h: float) -> datetime:
    return START + timedelta(hours=h)


def deliver(spark, folder, rows, run):
    append_table(spark.createDataFrame(rows, SCHEMA), f"{folder}/landing")
    query = run(jobs.landed_stream(spark, f"{folder}/landing", spark.createDataFrame([], SCHEMA).schema))
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def test_no_row_is_lost_and_late_ones_are_marked(spark, tmp_path):
    folder = str(tmp_path)

    def run(rows):
        return history.run_dedup(rows, f"{folder}/t", f"{folder}/state", ["id"], "at")

    deliver(spark, folder, [(1, hour(0), 1.0), (1, hour(0), 1.0), (2, hour(50), 2.0)], run)
    # Three days late, one hour late, no time at all, and repeats from long ago.
    deliver(spark, folder, [(3, hour(1), 3.0), (4, hour(49), 4.0), (5, None, 5.0), (1, hour(0), 1.0)], run)
    deliver(spark, folder, [(2, hour(50), 2.0), (3, hour(1), 3.0), (5, None, 5.0)], run)  # nothing new
    deliver(spark, folder, [(6, hour(900), 6.0), (1, hour(0), 1.0), (None, hour(900), 7.0), (None, hour(900), 7.0)], run)
    got = Counter((r.id, r.at, r.v, r.late) for r in history.stored_rows(spark, f"{folder}/t").collect())
    assert got == Counter(
        [
            (1, hour(0), 1.0, False),
            (2, hour(50), 2.0, False),
            (3, hour(1), 3.0, True),
            (4, hour(49), 4.0, False),
            (5, None, 5.0, False),
            (6, hour(900), 6.0, False),
            (None, hour(900), 7.0, False),
        ]
    )


def test_a_repeat_with_another_time_is_told_if_all_days_are_searched(spark, tmp_path):
    for same_day, count in ((False, 1), (True, 2)):
        folder = str(tmp_path / str(same_day))

        def run(rows, folder=folder, same_day=same_day):
            return history.run_dedup(rows, f"{folder}/t", f"{folder}/state", ["id"], "at", same_day=same_day)

        deliver(spark, folder, [(1, hour(0), 1.0)], run)
        deliver(spark, folder, [(1, hour(30), 1.0)], run)
        assert history.stored_rows(spark, f"{folder}/t").count() == count


def test_a_batch_that_dies_runs_again_with_the_same_result(spark, tmp_path, monkeypatch):
    folder, real = str(tmp_path), history.dedup_latest

    def dedup(rows):
        return history.run_dedup(rows, f"{folder}/t", f"{folder}/state", ["id"], "at")

    deliver(spark, folder, [(1, hour(0), 1.0), (2, hour(40), 2.0)], dedup)

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(history, "dedup_latest", dies)  # after the clock was written
    with pytest.raises(Exception, match="lost"):
        deliver(spark, folder, [(3, hour(2), 3.0), (1, hour(0), 1.0), (4, hour(90), 4.0)], dedup)
    monkeypatch.setattr(history, "dedup_latest", real)
    deliver(spark, folder, [(5, hour(91), 5.0)], dedup)
    got = sorted((r.id, r.late) for r in history.stored_rows(spark, f"{folder}/t").collect())
    assert got == [(1, False), (2, False), (3, True), (4, False), (5, False)]


def test_history_is_read_by_day_and_key_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, f"2024-01-0{i % 5 + 1}") for i in range(50)], "id int, _day string").write.partitionBy("_day").parquet(path)
    stored = spark.read.schema("id int, _day string").parquet(path)
    batch = spark.createDataFrame([(7, "2024-01-03"), (8, "2024-01-03"), (9, "2024-01-05")], "id int, _day string")
    fresh = history.unseen(batch, stored, ["id"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in fresh.collect()) == [8]
    assert "PartitionFilters: [(_day" in plan and "GreaterThanOrEqual(id,7)" in plan and "LessThanOrEqual(id,9)" in plan


def test_late_rows_change_their_hour_and_are_counted(spark, tmp_path):
    folder = str(tmp_path)

    def run(rows):
        return history.run_hourly_last(rows, f"{folder}/t", f"{folder}/state", ["id"], "at", "v")

    deliver(spark, folder, [(1, hour(0.1), 1.0), (1, hour(0.5), None), (2, hour(80.5), 2.0)], run)
    deliver(spark, folder, [(1, hour(0.2), 9.0), (1, hour(0.05), 8.0), (2, hour(80.4), 7.0), (2, hour(3), None)], run)
    deliver(spark, folder, [(1, hour(0.2), 9.0)], run)
    got = {(r.id, r.date_hour): r.v for r in history.hourly_rows(spark, f"{folder}/t", ["id"], "v").collect()}
    assert got == {(1, hour(0)): 9.0, (2, hour(80)): 2.0, (2, hour(3)): None}
    counts = {(r.id, r.date_hour): r["rows"] for r in history.late_counts(spark, f"{folder}/t", ["id"]).collect()}
    assert counts == {(1, hour(0)): 3, (2, hour(3)): 1}
