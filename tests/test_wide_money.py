"""Products and sums beyond 38 digits against Python's exact decimals."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from ledgerlens.functions.wide import wide_limbs, wide_product, wide_product_limbs, wide_text
from ledgerlens.operators import money
from ledgerlens.workload.operator_queries import OPERATORS

UNIT = Decimal(1).scaleb(-18)


def _number(rng: random.Random) -> str:
    whole = str(rng.randrange(10 ** rng.randint(1, 56)))
    text = whole if rng.random() < 0.3 else f"{whole}.{rng.randrange(10 ** 20):020d}"[: len(whole) + 1 + rng.randint(1, 20)]
    return rng.choice(["", "", "-", "+"]) + text


def _plain(value: Decimal) -> str:
    text = f"{value.quantize(UNIT, rounding=ROUND_HALF_UP):f}"
    return text.removeprefix("-") if not value.quantize(UNIT, rounding=ROUND_HALF_UP) else text


def test_products_equal_exact_ones(spark):
    rng = random.Random(5)
    pairs = [(_number(rng), _number(rng)) for _ in range(300)]
    # Halves round away from zero; zeros have no sign; exponents are read.
    pairs += [("0.0000000000000000005", "1"), ("-0.0000000000000000005", "1"), ("-0.4e-18", "1"), ("-0", "7"), ("1.5E30", "-2e3"), (".5", "5.")]
    pairs += [("9" * 56 + "." + "9" * 20, "-" + "9" * 56 + "." + "9" * 20)]
    df = spark.createDataFrame(pairs, "a string, b string")
    with localcontext() as context:
        context.prec = 250
        for row in df.select("a", "b", wide_product(F.col("a"), F.col("b")).alias("x")).collect():
            assert row.x == _plain(Decimal(row.a) * Decimal(row.b)), row


def test_limbs_of_products_equal_those_of_their_text(spark):
    rng = random.Random(9)
    pairs = [(_number(rng), _number(rng)) for _ in range(200)]
    pairs += [("-0.0000000000000000005", "1"), ("-0.4e-18", "1"), ("-0", "7"), ("n/a", "1"), (None, "1"), ("9" * 57, "1")]
    pairs += [("9" * 56 + "." + "9" * 20, "-" + "9" * 56 + "." + "9" * 20)]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    for row in df.select("a", "b", wide_product_limbs(a, b).alias("x"), wide_limbs(wide_product(a, b)).alias("y")).collect():
        assert row.x == row.y, row


def test_one_piece_is_valued_by_many_tasks(spark):
    rows = spark.range(40, numPartitions=1).select((F.col("id") % 2).alias("k"), F.lit("2").alias("a"), F.lit("3").alias("p"))
    assert {r.k: r.usd_total for r in money.usd_totals(money.spread(rows), ["k"], "a", "p").collect()} == {0: "120." + "0" * 18, 1: "120." + "0" * 18}
    for name in ("agg_usd_total_wide", "proj_usd_quarantine"):
        found = OPERATORS[name].run(spark, "/root/testdata/sf0.001")
        assert "RoundRobinPartitioning" in found._jdf.queryExecution().executedPlan().toString()


def test_unreadable_and_too_large_numbers_have_no_limbs(spark):
    bad = ["", " ", ".", "-", "n/a", "1,5", "1e", "NaN", "1e57", "9" * 57, None]
    df = spark.createDataFrame([(x,) for x in bad], "a string")
    assert all(row[0] is None for row in df.select(wide_product(F.col("a"), F.lit("1"))).collect())


def test_limbs_and_text_round_trip(spark):
    texts = ["0.000000000000000000", "-0.000000000000000001", "1" * 112 + "." + "2" * 18, "-" + "9" * 112 + "." + "9" * 18]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    assert [row[0] for row in df.select(wide_text(wide_limbs(F.col("a")))).collect()] == texts


def test_totals_count_every_value(spark):
    rng = random.Random(7)
    rows = [(rng.choice("xxxxyz"), _number(rng), _number(rng)) for _ in range(200)]
    rows += [("x", f"{rng.randint(-10**6, 10**6)}.25", "3.5") for _ in range(200)]
    rows += [("x", "n/a", "1"), ("x", None, "1"), ("x", "1", None), ("only null", None, "2"), ("bad", "?", "2")]
    rows += [("cancels", "5" + "0" * 30, "1"), ("cancels", "-5" + "0" * 30, "1"), ("cancels", "-0.25", "1")]
    df = spark.createDataFrame(rows, "k string, a string, p string").repartition(5)
    got = {row.k: row for row in money.usd_totals(df, ["k"], "a", "p").collect()}
    with localcontext() as context:
        context.prec = 250
        for k in ("x", "y", "z", "cancels"):
            values = [
                (Decimal(a) * Decimal(p)).quantize(UNIT, rounding=ROUND_HALF_UP)
                for key, a, p in rows
                if key == k and a not in (None, "n/a") and p is not None
            ]
            assert Decimal(got[k].usd_total) == sum(values)
    assert got["x"].n_unreadable == 1 and got["bad"].n_unreadable == 1
    assert got["cancels"].usd == Decimal("-0.25") and got["cancels"].n_wide == 2
    assert got["only null"].usd_total is None and got["bad"].usd_total is None


def test_quarantine_lists_reasons(spark):
    rows = [
        (1, "1" + "0" * 25, "2"),
        (2, "2", "1" + "0" * 25),
        (3, "1" + "0" * 15, "1" + "0" * 12),
        (4, "x", "1"),
        (5, "1", "x"),
        (6, "2", "3"),
        (7, None, "3"),
        (8, "9" * 60, "3"),
    ]
    df = spark.createDataFrame(rows, "id int, a string, p string")
    got = {row.id: (row.reason, row.usd_wide) for row in money.quarantine(df, ["id"], "a", "p").collect()}
    zeros = "." + "0" * 18
    assert got == {
        1: ("amount_too_large", "2" + "0" * 25 + zeros),
        2: ("price_too_large", "2" + "0" * 25 + zeros),
        3: ("product_too_large", "1" + "0" * 27 + zeros),
        4: ("amount_unreadable", None),
        5: ("price_unreadable", None),
        8: ("amount_unreadable", None),
    }
    assert money.quarantine(df.where("id > 100"), ["id"], "a", "p").count() == 0
    assert money.usd_totals(df.where("id > 100"), ["id"], "a", "p").count() == 0


def test_sums_combine_before_the_shuffle(spark):
    df = spark.createDataFrame([("x", "1", "1")], "k string, a string, p string")
    plan = money.usd_totals(df, ["k"], "a", "p")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("partial_sum") > 2
