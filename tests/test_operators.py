from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import asof as asof_module
from ledgerlens.operators import aggregates, joins, merge, positions, rollup
from ledgerlens.operators.asof import asof_join_left, asof_join_ranged

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def asof(spark, left, right, join=asof_join_left, **options):
    quotes = spark.createDataFrame(right, "k string, rt timestamp_ntz, price double")
    rows = spark.createDataFrame(left, "id int, k string, lt timestamp_ntz")
    joined = join(rows, quotes, ["k"], "lt", "rt", ["price"], match_flag="hit", **options)
    return {r.id: (r.price, r.hit) for r in joined.collect()}


@pytest.mark.parametrize("join", [asof_join_left, asof_join_ranged])
def test_asof_corners(spark, join):
    right = [("a", at(100), 1.0), ("a", at(200), None), ("a", at(9000), 3.0), ("b", at(0), 9.0)]
    left = [
        (1, "a", at(99)),
        (2, "a", at(100)),
        (3, "a", at(250)),
        (4, "a", at(8999)),
        (5, "a", at(9000)),
        (6, "c", at(500)),
        (7, None, at(500)),
        (8, "a", None),
    ]
    assert asof(spark, left, right, join) == {
        1: (None, False),
        2: (1.0, True),
        3: (None, True),
        4: (None, True),
        5: (3.0, True),
        6: (None, False),
        7: (None, False),
        8: (None, False),
    }


def test_asof_against_brute_force_with_a_hot_key_and_copies(spark):
    random.seed(5)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    right = [(random.choice(keys), at(random.randint(0, 50_000)), float(i)) for i in range(300)]
    left = [(i, random.choice(keys), at(random.randint(0, 50_000))) for i in range(600)]
    left += [(1000 + i, "hot", at(40_000)) for i in range(300)]
    expected = {}
    for i, k, t in left:
        seen = [(rt, p) for rk, rt, p in right if rk == k and rt <= t]
        expected[i] = (max(seen)[1], True) if seen else (None, False)
    for seconds in (60, 3600, 10**7):
        assert asof(spark, left, right, slice_seconds=seconds) == expected
    assert asof(spark, left, right, asof_join_ranged) == expected


def test_ranged_asof_of_one_key_over_many_partitions(spark, monkeypatch):
    """One key holds every row and one moment a third of them; parts without right rows take what came before."""
    right = [("hot", at(10 * i), float(i)) for i in range(40)] + [("hot", at(50), 99.0)]
    left = [(i, "hot", at(i // 3)) for i in range(1_500)] + [(5_000 + i, "hot", at(395)) for i in range(700)] + [(9_999, "hot", None)]
    quotes = spark.createDataFrame(right, "k string, rt timestamp_ntz, price double")
    rows = spark.createDataFrame(left, "id int, k string, lt timestamp_ntz")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = asof_join_ranged(rows, quotes, ["k"], "lt", "rt", ["price"])
        got = {r.id: r.price for r in joined.collect()}
        parts = spark.read.parquet(joined.inputFiles()[0].rsplit("/", 1)[0]).where("not _edge").groupBy("_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = {}
    for i, _, t in left:
        seen = [(rt, p) for _, rt, p in right if t is not None and rt <= t]
        expected[i] = max(seen)[1] if seen else None
    assert got == expected
    assert len(parts) == 16 and max(r["count"] for r in parts) < 400


def test_ranged_asof_reads_each_side_once(spark, tmp_path):
    for name, schema in (("l", "id int, k string, lt timestamp_ntz"), ("r", "k string, rt timestamp_ntz, price double")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    rows, quotes = (spark.read.parquet(str(tmp_path / n)) for n in "lr")
    plans = []
    real = asof_module.materialize
    try:
        asof_module.materialize = lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, label)
        assert asof_join_ranged(rows, quotes, ["k"], "lt", "rt", ["price"]).count() == 0
    finally:
        asof_module.materialize = real
    assert plans[0].count("FileScan parquet") == 2 and plans[0].count("Exchange rangepartitioning") == 1


def test_latest_value_skips_null_and_breaks_ties(spark):
    rows = [
        ("a", at(10), 1.0),
        ("a", at(20), None),
        ("a", at(5000), 2.0),
        ("a", at(5000), 7.0),
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    got = rollup.hourly_last(df, ["k"], "ts", {"v": "v"}).orderBy("date_hour").collect()
    assert [r.v for r in got] == [1.0, 7.0]


def test_dedup_and_fold(spark):
    df = spark.createDataFrame(
        [("k", 1, "old", None, ["x"]), ("k", 2, None, 5, []), ("k", 2, None, 4, [])],
        "key string, ver int, name string, n int, tags array<string>",
    )
    assert tuple(merge.dedup_latest(df, ["key"], ["ver"]).first()) == ("k", 2, None, 5, [])
    folded = merge.coalesce_merge(df, ["key"], ["name", "n", "tags"], ["ver", "n"]).first()
    assert tuple(folded) == ("k", "old", 5, ["x"])
    lone = df.where("ver = 2 and n = 5")
    assert merge.coalesce_merge(lone, ["key"], ["name", "n", "tags"]).first().tags == []


def test_latest_load_drops_older_and_unlogged_rows(spark):
    rows = spark.createDataFrame(
        [("A", 1, "L1"), ("a", 2, "L2"), ("b", 3, "L1"), ("b", 4, "L9")], "addr string, v int, _load_id string"
    )
    loads = spark.createDataFrame([("L1", at(0)), ("L2", at(5))], "load_id string, inserted_at timestamp_ntz")
    kept = merge.latest_load(rows, loads, {"addr": F.lower("addr")})
    assert sorted(r.v for r in kept.collect()) == [2, 3]


def test_global_rank_and_ranks_both_ways(spark):
    values = [(i, None if i % 7 == 0 else (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(values, "id int, v int").repartition(6)
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = {r.id: r["rank"] for r in positions.rank_global(df, order).collect()}
    ordered = sorted(values, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {row[0]: n for n, row in enumerate(ordered, start=1)}
    both = positions.rank_both_ways(df, ["id"], {"v": "v"}).collect()
    assert {r.id: r.rank_v_gainer for r in both} == got
    losers = sorted(values, key=lambda r: (r[1] is None, r[1] or 0, r[0] if r[1] is None else -r[0]))
    assert {r.id: r.rank_v_loser for r in both} == {r[0]: n for n, r in enumerate(losers, start=1)}


def test_quantiles_of_small_and_large_groups(spark):
    random.seed(2)
    rows = [("hot", round(random.random(), 3), i % 3) for i in range(500)]
    rows += [("small", 1.0, 1), ("small", 2.0, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    for copies in (1, 3):  # the same answer however the rows lie
        got = positions.exact_quantiles(df.repartition(3 * copies), ["g"], ["v", "w"])
        got = {r.g: r for r in got.collect()}
        assert set(got) == {"hot", "small", "none"}
        expected = np.quantile([r[1] for r in rows if r[0] == "hot"], probabilities)
        assert np.allclose(got["hot"].v_quantiles, expected)
        assert got["small"].v_quantiles == [1.0, 1.25, 1.5, 1.75, 2.0]
        assert got["small"].w_quantiles == [1.0] * 5
        assert got["none"].v_quantiles is None


def test_every_match(spark):
    facts = spark.createDataFrame([(i,) for i in range(50)], "id int")
    dim = spark.createDataFrame([("x",), ("y",), ("z",)], "name string")
    wanted = sorted((i, n) for i in range(50) for n in "xyz")
    got = joins.join_every_match(facts, dim, ["id"])
    assert got.columns == ["id", "name"]
    assert sorted(tuple(r) for r in got.collect()) == wanted


def test_either_key_matches_once(spark):
    left = spark.createDataFrame([(1, "p", "q"), (1, "p", "p"), (1, None, "r")], "c int, a string, b string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (1, "r"), (2, "p")], "d int, k string")
    got = joins.join_either_key(left, right, [("c", "d")], [("a", "k"), ("b", "k")])
    pairs = sorted((r.a or "", r.b, r.k) for r in got.collect())
    assert pairs == [("", "r", "r"), ("p", "p", "p"), ("p", "q", "p"), ("p", "q", "q")]


def test_legs_and_mode(spark):
    rows = [
        (1, "in", 2, "b", None),
        (1, "in", 1, "a", 5.0),
        (1, "in", 2, "a", 1.0),
        (1, "out", 1, "z", 2.0),
        (2, "other", 1, "q", 1.0),
    ]
    df = spark.createDataFrame(rows, "txn int, kind string, idx int, token string, usd double")
    got = aggregates.legs_to_arrays(
        df, ["txn"], "kind", {"inp": "in", "out": "out"}, ["idx", "token"], {"tokens": "token", "usd": "usd"}
    ).collect()
    assert [tuple(r) for r in got] == [(1, ["a", "a", "b"], [5.0, 1.0, None], ["z"], [2.0])]
    assert tuple(aggregates.most_frequent(df, ["txn"], "token").where("txn = 1").first()) == (1, "a")
    tied = df.where("txn = 1 and idx = 1")
    assert aggregates.most_frequent(tied, ["txn"], "token").first().token == "a"
