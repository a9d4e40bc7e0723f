"""Product and chain statistics: hourly rollups, their fold, latest rows and TVL changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.filters import after_epoch, since, within_bounds
from ledgerlens.operators.lookback import point_lookback
from ledgerlens.operators.merge import coalesce_merge
from ledgerlens.operators.positions import rank_both_ways
from ledgerlens.operators.rollup import hourly_last, latest_per_entity
from ledgerlens.operators.setops import union_padded
from ledgerlens.plans.dimensions import chain, product
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.streaming.cursors import new_rows

ENTITY = ["chain_id", "product_address"]
LATEST_DAYS = 15

# Metrics outside these inclusive bounds are feed errors.
MAX_RATE = 1_000_000
MAX_FEE = 1_000_000_000
MAX_AMOUNT = 1_000_000_000_000
MAX_PRICE = 1_000_000

FEES = ["compoundings_per_year", "performance_fee", "lp_fee"]
RATES = [
    "total_apy",
    "vault_apr",
    "trading_apr",
    "clm_apr",
    "reward_pool_apr",
    "reward_pool_trading_apr",
    "vault_apy",
]
OTHER_RATES = ["liquid_staking_apr", "composable_pool_apr", "merkl_apr", "linea_ignition_apr"]
BREAKDOWN = FEES + RATES + OTHER_RATES
LP_COLUMNS = [
    "lp_price",
    "breakdown_tokens",
    "breakdown_balances",
    "total_supply",
    "underlying_liquidity",
    "underlying_balances",
    "underlying_price",
]
YIELD_COLUMNS = [
    "underlying_amount_compounded",
    "underlying_token_price_usd",
    "underlying_amount_compounded_usd",
]
HARVEST_COLUMNS = [
    "harvest_call_fee",
    "harvest_call_fee_usd",
    "gas_fee",
    "gas_fee_usd",
    "platform_fee",
    "platform_fee_usd",
    "strategist_fee",
    "strategist_fee_usd",
    "harvest_amount",
    "harvest_amount_usd",
    "avg_native_price",
    "harvest_txn_count",
    "harvest_vault_count",
]
#: Columns of the hourly sources, in their order.
SOURCE_COLUMNS = [["tvl_usd"], ["apy"], BREAKDOWN, LP_COLUMNS, YIELD_COLUMNS, HARVEST_COLUMNS]
METRICS = [c for columns in SOURCE_COLUMNS for c in columns]


def _by_key(w: Warehouse, rows: DataFrame, key: str) -> DataFrame:
    """Rows joined to the products with that key (a key used on two chains matches both)."""
    products = w.model(product).select("chain_id", "product_address", F.col("product_key").alias(key))
    return rows.join(products, key)


def _series(w: Warehouse, name: str) -> DataFrame:
    ids = staging(w, "db_vault_ids")
    return _by_key(w, staging(w, name).join(ids, "vault_id"), "product_key")


def product_harvests(w: Warehouse) -> DataFrame:
    """Usable harvests with their product."""
    products = w.model(product).select(
        F.col("chain_id").alias("network_id"),
        "chain_id",
        "product_address",
        "product_key",
        "product_type",
        "display_name",
    )
    return staging(w, "db_harvests").join(products, ["network_id", "product_key"])


def int_tvl(w: Warehouse) -> DataFrame:
    """API TVL snapshots per product."""
    products = w.model(product).select(
        F.col("chain_id").alias("network_id"),
        F.col("product_key").alias("vault_id"),
        "chain_id",
        "product_address",
    )
    return staging(w, "api_tvl").join(products, ["network_id", "vault_id"]).select(
        "chain_id", "product_address", "date_time", "tvl"
    )


def int_yield(w: Warehouse, start: datetime | None = None) -> DataFrame:
    """Compounded yield per harvest in USD; ``start`` limits an incremental run."""
    amount, price = F.col("harvest_amount"), F.col("want_price")
    rows = w.model(product_harvests).where(after_epoch(F.col("txn_timestamp")))
    if start is not None:
        rows = new_rows(rows, "txn_timestamp", start, w.as_of)
    return rows.select(
        "txn_timestamp",
        "chain_id",
        "product_address",
        "block_number",
        "txn_idx",
        "event_idx",
        "txn_hash",
        amount.alias("underlying_amount_compounded"),
        price.alias("underlying_token_price_usd"),
        fn.usd_value(amount, price).alias("underlying_amount_compounded_usd"),
    )


def _incremental(w: Warehouse, rows: DataFrame, start: datetime | None, ts: str = "date_time") -> DataFrame:
    """Rows from ``start`` on, bounded before any rollup so that the bound reaches the scan."""
    if start is None:
        return rows
    # Whole hours are recomputed, so the bound starts at an hour.
    return new_rows(rows, ts, start.replace(minute=0, second=0, microsecond=0), w.as_of)


def _hourly(rows: DataFrame, ts: str, values: dict[str, str], tie_break: Sequence[str] = ()) -> DataFrame:
    """Last values per product and hour. An hour of one product has few rows, so nothing is combined before the shuffle."""
    return hourly_last(rows, ENTITY, ts, values, tie_break, combine=False)


def tvl_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    rows = _incremental(w, _series(w, "db_tvls"), start)
    rows = rows.where(within_bounds({"tvl_usd": (0.0, 1e9)}))
    return _hourly(rows, "date_time", {"tvl_usd": "tvl_usd"})


def apy_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    rows = _incremental(w, _series(w, "db_apys"), start)
    rows = rows.where(within_bounds({"apy": (0.0, float(MAX_RATE))}))
    return _hourly(rows, "date_time", {"apy": "apy"})


def apy_breakdown_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    bounds = {c: (0, MAX_FEE) for c in FEES} | {c: (0, MAX_RATE) for c in RATES}
    rows = _incremental(w, staging(w, "api_apy_breakdown"), start).where(within_bounds(bounds))
    return _hourly(_by_key(w, rows, "vault_id"), "date_time", {c: c for c in BREAKDOWN})


def lps_breakdown_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    bounds = {
        "price": (0, MAX_PRICE),
        "total_supply": (0, MAX_AMOUNT),
        "underlying_liquidity": (0, MAX_AMOUNT),
        "underlying_price": (0, MAX_PRICE),
    }
    rows = _incremental(w, staging(w, "api_lps_breakdown"), start).where(within_bounds(bounds))
    named = {"lp_price": "price", "breakdown_tokens": "tokens", "breakdown_balances": "balances"}
    named |= {c: c for c in LP_COLUMNS if c not in named}
    return _hourly(_by_key(w, rows, "vault_id"), "date_time", named)


def yield_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    amount, price, usd = YIELD_COLUMNS
    bounds = {amount: (0, MAX_AMOUNT), price: (0, MAX_PRICE), usd: (0, MAX_AMOUNT)}
    rows = _incremental(w, w.model(int_yield), start, "txn_timestamp").where(within_bounds(bounds))
    order = ["block_number", "txn_idx", "event_idx"]
    return _hourly(rows, "txn_timestamp", {c: c for c in YIELD_COLUMNS}, order)


def harvest_hourly(w: Warehouse, start: datetime | None = None) -> DataFrame:
    native = F.col("native_price")

    def total(amount: str) -> Column:
        return F.sum(fn.usd_value(F.col(amount), native))

    rows = w.model(product_harvests).where(after_epoch(F.col("txn_timestamp")))
    rows = _incremental(w, rows, start, "txn_timestamp")
    # By product and hour first: the distinct count then needs no shuffle of its own.
    rows = rows.withColumn("date_hour", fn.hour_of(F.col("txn_timestamp"))).repartition(*ENTITY, "date_hour")
    return rows.groupBy(*ENTITY, "date_hour").agg(
        F.sum("call_fee").alias("harvest_call_fee"),
        total("call_fee").alias("harvest_call_fee_usd"),
        F.sum("gas_fee").alias("gas_fee"),
        total("gas_fee").alias("gas_fee_usd"),
        F.sum("platform_fee").alias("platform_fee"),
        total("platform_fee").alias("platform_fee_usd"),
        F.sum("strategist_fee").alias("strategist_fee"),
        total("strategist_fee").alias("strategist_fee_usd"),
        F.sum("harvest_amount").alias("harvest_amount"),
        F.sum(fn.usd_value(F.col("harvest_amount"), F.col("want_price"))).alias("harvest_amount_usd"),
        F.avg(native.cast("double")).alias("avg_native_price"),
        F.count_distinct("txn_hash").alias("harvest_txn_count"),
        F.lit(1).cast("bigint").alias("harvest_vault_count"),
    )


HOURLY_SOURCES = {
    "tvl": tvl_hourly,
    "apy": apy_hourly,
    "apy_breakdown": apy_breakdown_hourly,
    "lps_breakdown": lps_breakdown_hourly,
    "yield": yield_hourly,
    "harvest": harvest_hourly,
}


def unified_hourly(w: Warehouse, starts: dict[str, datetime] | None = None) -> DataFrame:
    """The six hourly sources stacked into one sparse table, tagged by source.

    ``starts`` gives each source its own incremental start, since sources
    advance independently.
    """
    branches = {
        name: w.model(build) if starts is None else build(w, starts[name])
        for name, build in HOURLY_SOURCES.items()
    }
    return union_padded(branches).select(*ENTITY, "date_hour", "source", *METRICS)


def product_stats(w: Warehouse, start: datetime | None = None) -> DataFrame:
    """One row per product and hour: the sparse rows of all sources folded together."""
    sparse = w.model(unified_hourly)
    if start is not None:
        sparse = sparse.where(F.col("date_hour") >= F.lit(str(start)).cast("timestamp_ntz"))
    return folded_stats(w, sparse)


def folded_stats(w: Warehouse, sparse: DataFrame) -> DataFrame:
    """Sparse hourly rows folded to one row per product and hour, with the product's labels."""
    # One shuffle by product serves the fold and the labels; a product has at most six rows an hour.
    sparse = sparse.repartition(*ENTITY)
    folded = coalesce_merge(sparse, [*ENTITY, "date_hour"], METRICS, together=SOURCE_COLUMNS)
    chains = w.model(chain).select("chain_id", "chain_name")
    products = w.model(product).select(
        *ENTITY, "product_type", "product_key", "display_name", "is_active", "platform_id"
    )
    return folded.join(chains, "chain_id").join(products, ENTITY).select(
        "chain_id",
        "chain_name",
        "product_type",
        "product_key",
        "product_address",
        "display_name",
        "is_active",
        "platform_id",
        "date_hour",
        *METRICS,
    )


LATEST_LABELS = ["product_type", "product_key", "display_name", "platform_id", "chain_name", "is_active"]
LATEST_METRICS = ["tvl_usd", "apy", *BREAKDOWN, *LP_COLUMNS, *YIELD_COLUMNS]


def product_stats_latest(w: Warehouse) -> DataFrame:
    # The bound is one on the key of every rollup, so it goes before all of them.
    recent = w.part(product_stats).where(since(F.col("date_hour"), w.as_of, LATEST_DAYS))
    # The hour itself is read twice by the aggregate, hence the copy.
    rows = recent.withColumn("_hour", F.col("date_hour"))
    return latest_per_entity(rows, ENTITY, "_hour", [*LATEST_LABELS, "date_hour", *LATEST_METRICS])


CHAIN_AVERAGES = ["performance_fee", "lp_fee", "compoundings_per_year", "apy", *RATES, *OTHER_RATES]
CHAIN_SUMS = ["underlying_amount_compounded_usd", *[c for c in HARVEST_COLUMNS if c != "avg_native_price"]]


def chain_stats(w: Warehouse) -> DataFrame:
    """Chain and hour totals, averages and quantiles over the chain's products."""
    return chain_totals(w, w.model(product_stats))


def chain_totals(w: Warehouse, stats: DataFrame) -> DataFrame:
    """The same from given rows per product and hour; all products of an hour must be among them."""
    tvl = F.col("tvl_usd").cast("decimal(28,8)")

    def tvl_of(kind: str) -> Column:
        return F.sum(F.when(F.col("product_type") == kind, tvl).otherwise(F.lit(0).cast("decimal(28,8)")))

    keys = ["chain_id", "date_hour"]
    shares = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])
    # A group is one hour of one chain: one row per product at most.
    totals = stats.groupBy(*keys).agg(
        F.sum(tvl).alias("tvl_usd"),
        tvl_of("classic_vault").alias("vault_tvl_usd"),
        tvl_of("clm_manager").alias("clm_tvl_usd"),
        *[F.avg(c).alias(f"avg_{c}") for c in CHAIN_AVERAGES],
        *[F.sum(c).alias(c) for c in CHAIN_SUMS],
        F.avg("avg_native_price").alias("avg_native_price"),
        *[F.percentile(c, shares).alias(f"{c}_quantiles") for c in CHAIN_AVERAGES],
    )
    chains = w.model(chain).select("chain_id", "chain_name", "chain_key", "is_enabled")
    return totals.join(chains, "chain_id")


def chain_stats_latest(w: Warehouse) -> DataFrame:
    recent = w.model(chain_stats).where(since(F.col("date_hour"), w.as_of, LATEST_DAYS))
    rows = recent.withColumn("_hour", F.col("date_hour"))
    return latest_per_entity(
        rows, ["chain_id"], "_hour", [c for c in recent.columns if c != "chain_id"]
    )


PERIODS = {"1d": 1, "1w": 7, "1m": 30, "1y": 365}


def product_tvl_diff(w: Warehouse) -> DataFrame:
    """TVL change of every current product over four periods, ranked both ways."""
    latest = w.model(product_stats_latest).select(
        *ENTITY,
        "product_type",
        "product_key",
        "display_name",
        "is_active",
        "platform_id",
        F.col("date_hour").alias("ref_hour"),
        F.col("tvl_usd").alias("tvl_usd_current"),
    )
    past = point_lookback(w.part(product_stats), ENTITY, "date_hour", "tvl_usd", w.as_of, PERIODS)
    changes = latest.join(past, ENTITY, "left").withColumns(
        {
            f"tvl_usd_diff_{p}": F.col("tvl_usd_current") - F.col(f"tvl_usd_{p}_ago")
            for p in PERIODS
        }
    )
    ranks = rank_both_ways(changes, ENTITY, {p: f"tvl_usd_diff_{p}" for p in PERIODS})
    return changes.join(ranks, ENTITY)
