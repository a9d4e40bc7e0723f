from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import rollup
from ledgerlens.quality import checks, suite
from ledgerlens.sinks import loads, upsert, versions, writers
from ledgerlens.sources.tables import FileTable, read_optional
from ledgerlens.streaming import cursors, jobs

ROWS = "k int, day string, v string"


def rows_of(spark, path):
    return sorted(tuple(r) for r in writers.read_table(spark, path).select("k", "day", "v").collect())


def test_upsert_new_changed_repeated_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "d1", "a"), (2, "d2", "b"), (None, "d2", "n")], ROWS)
    upsert.upsert(first, path, ["k", "day"], partition_by="day")
    batch = spark.createDataFrame([(2, "d2", "B"), (3, "d3", "c"), (None, "d2", "N")], ROWS)
    for _ in range(2):
        upsert.upsert(batch, path, ["k", "day"], partition_by="day")
        stored = writers.read_table(spark, path)
        got = sorted((r.k or 0, r.day, r.v) for r in stored.collect())
        assert got == [(0, "d2", "N"), (1, "d1", "a"), (2, "d2", "B"), (3, "d3", "c")]
    upsert.upsert(batch.where("false"), path, ["k", "day"], partition_by="day")
    assert writers.read_table(spark, path).count() == 4


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("2024").alias("day"), F.lit("a").alias("v"))
    upsert.upsert(rows, path, ["k"], partition_by="day")
    broken = rows.withColumn("v", F.when(F.col("k") == 57, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")))
    for write in (lambda: writers.write_table(broken, path, partition_by="day"), lambda: upsert.upsert(broken, path, ["k"], partition_by="day")):
        with pytest.raises(Exception, match="lost"):
            write()
        assert {r.v for r in writers.read_table(spark, path).collect()} == {"a"}
    # A partition value that looks like a number stays text.
    upsert.upsert(rows.limit(1).withColumn("v", F.lit("c")), path, ["k"], partition_by="day")
    stored = writers.read_table(spark, path)
    assert stored.count() == 100 and dict(stored.dtypes)["day"] == "string"


def test_a_folder_without_a_version_is_no_new_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d", "a")], ROWS)
    rows.write.parquet(path)
    with pytest.raises(versions.TableBroken):
        upsert.upsert(rows, path, ["k"])


def test_two_writers_from_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d", "a")], ROWS)
    writers.write_table(rows, path)
    seen = versions.current_version(spark, path)
    versions.publish(rows.withColumn("v", F.lit("b")), path, based_on=seen)
    with pytest.raises(versions.VersionTaken):
        versions.publish(rows.withColumn("v", F.lit("c")), path, based_on=seen)
    assert writers.read_table(spark, path).first().v == "b"


def test_a_writer_that_died_does_not_block_the_next(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d", "a")], ROWS)
    writers.write_table(rows, path)
    (tmp_path / "t/manifest/v2").mkdir()
    (tmp_path / "t/manifest/v2/part-0.json").write_text("{")
    (tmp_path / "t/manifest/.v2-abc").mkdir()
    upsert.upsert(rows.withColumn("v", F.lit("b")), path, ["k"])
    assert versions.current_version(spark, path).number == 2
    assert writers.read_table(spark, path).first().v == "b"


def test_readers_keep_their_version_until_it_is_expired(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d", "a"), (2, "e", "a")], ROWS)
    writers.write_table(rows, path, partition_by="day")
    old = writers.read_table(spark, path)
    for v in "bcd":
        upsert.upsert(rows.where("k = 1").withColumn("v", F.lit(v)), path, ["k"], partition_by="day")
    assert {r.v for r in old.collect()} == {"a"}
    versions.expire_versions(spark, path, keep=1)
    assert sorted((r.k, r.v) for r in writers.read_table(spark, path).collect()) == [(1, "d"), (2, "a")]
    assert len(list((tmp_path / "t/manifest").iterdir())) == 1 and len(list((tmp_path / "t/data").iterdir())) == 2
    upsert.upsert(rows, path, ["k"], partition_by="day")
    assert {r.v for r in writers.read_table(spark, path).collect()} == {"a"}


def test_an_older_row_that_comes_later_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for k, at, v in [(1, "2", "new"), (1, "1", "old"), (2, "1", "x"), (2, "3", "y")]:
        upsert.upsert(spark.createDataFrame([(k, at, v)], ROWS), path, ["k"], version=["day"])
    assert rows_of(spark, path) == [(1, "2", "new"), (2, "3", "y")]


def test_schema_policies(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert(spark.createDataFrame([(1, "a", 5)], "k int, v string, old int"), path, ["k"])
    wider = spark.createDataFrame([(2, "b", 1.5)], "k int, v string, extra double")
    with pytest.raises(writers.SchemaChanged):
        upsert.upsert(wider, path, ["k"])
    upsert.upsert(wider, path, ["k"], on_schema_change="append_new_columns")
    assert writers.read_table(spark, path).orderBy("k").collect()[0].asDict() == {
        "k": 1,
        "v": "a",
        "old": 5,
        "extra": None,
    }
    upsert.upsert(wider, path, ["k"], on_schema_change="sync_all_columns")
    assert writers.read_table(spark, path).columns == ["k", "v", "extra"]


def test_load_log_and_optional_table(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    for _ in range(2):  # repeating a load changes nothing
        loads.append_load(df, table, log, "L1", "s", datetime(2024, 1, 1))
    loads.append_load(df.limit(0), table, log, "L2", "s", datetime(2024, 1, 2))
    logged = {r.load_id: r.row_count for r in loads.read_load_log(spark, log).collect()}
    assert logged == {"L1": 2, "L2": 0}
    assert loads.read_loads(spark, table, "k int").count() == 2
    assert read_optional(spark, FileTable(str(tmp_path / "nothing"))) is None


def test_cursors(spark):
    as_of = datetime(2024, 3, 20)
    assert cursors.catch_up_window(datetime(2024, 1, 31), as_of) == (
        datetime(2024, 1, 31),
        datetime(2024, 2, 29),
    )
    windows = []
    assert cursors.catch_up(datetime(2024, 1, 1), as_of, lambda a, b: windows.append((a, b))) == 3
    assert windows[-1] == (datetime(2024, 3, 1), as_of - timedelta(days=7))
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 5)), ("b", datetime(2024, 1, 9))], "tag string, ts timestamp_ntz"
    )
    assert cursors.lookback_starts(df, "tag", "ts", ["a", "c"]) == {
        "a": datetime(2024, 1, 4),
        "c": cursors.BEGINNING,
    }
    assert cursors.lookback_start(None, "ts") == cursors.BEGINNING


def test_late_rows_within_the_lookback_are_kept(spark, tmp_path):
    path = str(tmp_path / "hours")
    base = datetime(2024, 1, 10)
    seen = [("a", base, 1.0), ("a", base + timedelta(days=2), 2.0)]
    late = [
        ("a", base + timedelta(days=1, hours=1), 5.0),  # 23 hours late
        ("a", base + timedelta(hours=23), 6.0),  # 25 hours late
    ]
    schema = "k string, ts timestamp_ntz, v double"

    def hours(rows):
        out = rollup.hourly_last(rows, ["k"], "ts", {"v": "v"})
        return out.withColumn("day", F.to_date("date_hour"))

    upsert.upsert(hours(spark.createDataFrame(seen, schema)), path, ["k", "date_hour"], partition_by="day")
    start = cursors.lookback_start(writers.read_table(spark, path), "date_hour")
    fresh = cursors.new_rows(spark.createDataFrame(seen + late, schema), "ts", start, base + timedelta(days=3))
    upsert.upsert(hours(fresh), path, ["k", "date_hour"], partition_by="day")
    assert sorted(r.v for r in writers.read_table(spark, path).collect()) == [1.0, 2.0, 5.0]


def test_stream_equals_batch_over_several_files_and_runs(spark, tmp_path):
    base = datetime(2024, 1, 1)
    schema = "id int, k string, ts timestamp, v double"
    files = [
        [(1, "a", base, 1.0), (2, "a", base + timedelta(minutes=5), None)],
        [(3, "a", base + timedelta(minutes=9), 3.0), (1, "a", base, 1.0)],
        [(4, "b", base + timedelta(hours=3), 4.0)],
    ]
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    everything = spark.createDataFrame([r for f in files for r in f], schema)
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = jobs.landed_stream(spark, landing, everything.schema, files_per_trigger=1)
        hours = jobs.with_day(jobs.hourly_last_stream(stream, ["k"], "ts", "v"), "date_hour")
        query = jobs.run_upsert(
            hours, out, state, ["k", "date_hour"], partition_by="day", output_mode="update"
        )
        query.awaitTermination()
    batch = rollup.hourly_last(everything, ["k"], "ts", {"v": "v"}).select("k", "date_hour", "v")
    stored = writers.read_table(spark, out).select("k", "date_hour", "v")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))


def test_data_tests_pass_and_fail(spark):
    good = spark.createDataFrame([(1, "0xab", ["a"]), (2, "0xcd", ["b"])], "k int, h string, arr array<string>")
    bad = spark.createDataFrame([(1, "ab", ["z"]), (1, None, [])], "k int, h string, arr array<string>")
    parents = spark.createDataFrame([("a",), ("b",)], "id string")
    kinds = {
        "not_null": lambda df: checks.not_null(df, "h"),
        "unique": lambda df: checks.unique(df, ["k"]),
        "range": lambda df: checks.accepted_range(df.withColumn("k", F.col("k") * 2), "k", 3 - 1, 4)
        if df is good
        else checks.accepted_range(df, "k", 2, None),
        "hex": lambda df: checks.hex_string(df, "h", 1),
        "array": lambda df: checks.relationship_array(df, "arr", parents, "id"),
        "length": lambda df: checks.array_length(df, "arr", 1, 1),
        "expression": lambda df: checks.expression(df, "size(arr) = 1 and h like '0x%'"),
        "rows": lambda df: checks.exactly_one_row(df.where("k = 1")),
        "distinct": lambda df: checks.distinct_count_above(df, "k", 1),
        "contract": lambda df: checks.contract(
            df, {"k": "int", "h": "string", "arr": "array<string>"} if df is good else {"k": "bigint"}
        ),
    }
    for name, kind in kinds.items():
        assert kind(good).count() == 0, name
        assert kind(bad).count() > 0, name
    outcomes = suite.run_suite({"bad": (bad, {"not_null": kinds["not_null"]})})
    assert [(o.check, o.violations, o.passed) for o in outcomes] == [("not_null", 1, False)]
