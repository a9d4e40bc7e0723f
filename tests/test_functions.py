from __future__ import annotations

import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Context, Decimal, localcontext

from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.sources import payloads, schema


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_usd_value_is_the_rounded_exact_product(spark):
    random.seed(3)
    pairs = []
    for _ in range(400):
        amount = random.randint(-(10 ** random.randint(1, 29)), 10 ** random.randint(1, 29))
        price = random.randint(0, 10 ** random.randint(1, 24))
        pairs.append((Decimal(amount).scaleb(-18), Decimal(price).scaleb(-18)))
    pairs += [(Decimal("1e-18"), Decimal("1e6")), (Decimal("1e12"), Decimal("99999.5"))]
    df = spark.createDataFrame(pairs, "a decimal(38,18), p decimal(38,18)")
    usd = fn.usd_value(F.col("a"), F.col("p")).alias("usd")
    with localcontext() as context:
        context.prec = 100
        for row in df.select("a", "p", usd).collect():
            exact = (row.a * row.p).quantize(Decimal(1).scaleb(-18), rounding=ROUND_HALF_UP)
            assert row.usd == exact


def test_usd_overflow_is_null_and_reported(spark):
    df = spark.createDataFrame(
        [(Decimal("1e19"), Decimal(10)), (None, Decimal(1)), (Decimal(2), Decimal(3))],
        "a decimal(38,18), p decimal(38,18)",
    )
    a, p = F.col("a"), F.col("p")
    rows = df.select(fn.usd_value(a, p), fn.price_overflow(a, p)).collect()
    assert [tuple(r) for r in rows] == [(None, True), (None, False), (Decimal(6), False)]


def test_whole_coins_keeps_every_unit(spark):
    units = [0, 1, 10**18, 10**19 + 3, 987654321 * 10**20 + 17]
    df = spark.createDataFrame([(Decimal(u),) for u in units], "u decimal(38,0)")
    coins = [r[0] for r in df.select(fn.whole_coins(F.col("u"))).collect()]
    assert [int(c.scaleb(18, Context(prec=60))) for c in coins] == units


def test_native_address_texts(spark):
    values = [None, "", " Native ", "null", "0xAbC"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(fn.representation_address(F.col("x"))).collect()]
    assert got == [fn.NATIVE_ADDRESS] * 4 + ["0xabc"]


def test_json_lists_and_splits(spark):
    assert one(spark, fn.json_string_list(F.lit(None).cast("string"))) == []
    assert one(spark, fn.json_string_list(F.lit("oops"))) == []
    assert one(spark, fn.address_list(fn.json_string_list(F.lit('["0xA","native"]')))) == [
        "0xa",
        fn.NATIVE_ADDRESS,
    ]
    assert one(spark, fn.split_part(F.lit("56-0xa"), "-", 1)) == "0xa"
    assert one(spark, fn.split_part(F.lit("56"), "-", 1)) is None


def test_times_and_scaled_integers(spark):
    assert one(spark, fn.iso_timestamp(F.lit("2024-01-02T03:04:05Z"))) == datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, fn.iso_timestamp(F.lit(""))) is None
    assert one(spark, fn.epoch_to_null(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))) is None
    assert one(spark, fn.scaled_integer(F.lit("1500001"), 6)) == Decimal("1.500001")
    assert one(spark, fn.network_key(F.lit(" Harmony "))) == "one"
    assert one(spark, fn.safe_bigint(F.lit(" 12 "))) == 12


def test_schema_hints_keep_bad_values(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    rows = schema.apply_hints(df, {"v": "decimal(10,2)", "w": "bigint"}, keep_raw=True).collect()
    assert [tuple(r) for r in rows] == [(Decimal("1.50"), None, None), (None, "x", None), (None, None, None)]
    assert schema.camel_to_snake("srcNetworkId") == "src_network_id"


def test_three_level_payload(spark):
    text = '{"c1":{"w1":{"t1":{"usdValue":"NaN","symbol":"A"},"t2":null}},"c2":{}}'
    df = spark.createDataFrame([(text,)], "payload string")
    rows = payloads.explode_map(
        df, "payload", ["chain", "wallet", "token"], {"usd": "usdValue", "symbol": "symbol"}, drop_null=True
    )
    rows = rows.withColumn("usd", payloads.number_or_null(F.col("usd")))
    assert [tuple(r) for r in rows.collect()] == [("c1", "w1", "t1", None, "A")]


def test_landed_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1.5}')
    rows = payloads.read_payloads(spark, str(tmp_path))
    flat = payloads.explode_map(rows, "payload", ["k"], "v", ["etag", "date_time"]).collect()
    assert [(r.k, r.v) for r in flat] == [("x", "1.5")]
    assert len(flat[0].etag) == 64 and flat[0].date_time is not None
