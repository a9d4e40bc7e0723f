"""Investor timeline: balance changes valued at the price of their moment."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.asof import asof_join_left, asof_join_ranged
from ledgerlens.operators.merge import dedup_latest
from ledgerlens.operators.setops import union_at_cutover
from ledgerlens.plans.dimensions import chain, product
from ledgerlens.plans.prices import int_product_price
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.streaming.cursors import catch_up_window

HISTORY_START = datetime(2021, 7, 31, 19, 30)
HISTORY_LAG_DAYS = 7
RECENT_DAYS = 15
CUTOVER_DAYS = 11
TIMELINE_KEY = ["account_id", "datetime", "product_address", "transaction_hash", "log_index"]


PRICED = ["chain_id", "token_contract_address"]


def _inside(rows: DataFrame, ts: str, low: datetime, end: datetime | None) -> DataFrame:
    rows = rows.where(F.col(ts) >= F.lit(str(low)).cast("timestamp_ntz"))
    return rows if end is None else rows.where(F.col(ts) < F.lit(str(end)).cast("timestamp_ntz"))


def window_prices(w: Warehouse, start: datetime, end: datetime | None) -> DataFrame:
    """``chain_id, token_contract_address, date_time, price`` of product prices in ``[start, end)``."""
    prices = _inside(w.model(int_product_price), "date_time", start, end)
    return prices.withColumnRenamed("token_address", "token_contract_address").select(*PRICED, "date_time", "price")


def priced_changes(
    w: Warehouse,
    start: datetime,
    end: datetime | None,
    price_lookback_days: int = 0,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Balance changes in ``[start, end)`` with the latest product price at their time.

    Both inputs are cut to the window before the join. Changes before the
    window's first price are valued at zero, unless ``price_lookback_days`` lets
    older prices in or ``opening`` holds the last price of each product before the
    window (``closing_prices`` of the window before).
    """

    products = w.model(product).select(
        "chain_id",
        F.col("product_address").alias("token_contract_address"),
        "product_key",
        F.col("display_name").alias("product_display_name"),
        "product_type",
        (~F.col("is_active")).alias("is_eol"),
    )
    chains = w.model(chain).select("chain_id", "chain_name")
    changes = (
        _inside(staging(w, "idx_token_balance_change"), "block_timestamp", start, end)
        .join(products, ["chain_id", "token_contract_address"])
        .join(chains, "chain_id")
    )
    prices = window_prices(w, start - timedelta(days=price_lookback_days), end)
    if opening is None:
        priced = asof_join_left(changes, prices, PRICED, "block_timestamp", "date_time", ["price"])
    else:
        prices = prices.unionByName(opening.select(*PRICED, "date_time", "price"))
        priced = asof_join_ranged(changes, prices, PRICED, "block_timestamp", "date_time", ["price"])
    price = F.coalesce("price", F.lit(0).cast(fn.AMOUNT))
    unknown = F.lit(None).cast(fn.AMOUNT)
    return priced.select(
        F.col("block_timestamp").alias("datetime"),
        "account_id",
        "product_key",
        "product_display_name",
        "chain_id",
        "chain_name",
        "product_type",
        F.col("token_contract_address").alias("product_address"),
        "is_eol",
        F.col("is_eol").alias("is_dashboard_eol"),
        "block_number",
        F.col("trx_hash").alias("transaction_hash"),
        "log_index",
        unknown.alias("share_to_underlying_price"),
        unknown.alias("underlying_to_usd_price"),
        F.col("price").alias("share_to_usd_price"),
        F.col("balance_after").alias("share_balance_after"),
        F.col("balance_before").alias("share_balance_before"),
        F.col("share_diff").alias("share_balance_diff"),
        unknown.alias("underlying_balance_after"),
        unknown.alias("underlying_balance_before"),
        unknown.alias("underlying_balance_diff"),
        fn.usd_value(F.col("balance_before"), price).alias("usd_balance_before"),
        fn.usd_value(F.col("balance_after"), price).alias("usd_balance_after"),
        fn.usd_value(F.col("share_diff"), price).alias("usd_balance_diff"),
    )


def investor_timeline_historical(
    w: Warehouse, start: datetime | None = None, lag_days: int = HISTORY_LAG_DAYS
) -> DataFrame:
    """One catch-up batch: at most a month from ``start``, ending ``lag_days`` before as-of.

    ``_version`` is the run's time, the version column of the stored table.
    """
    low, high = catch_up_window(start or HISTORY_START, w.as_of, lag_days)
    version = F.lit(str(w.as_of)).cast("timestamp_ntz").alias("_version")
    return priced_changes(w, low, high).select(version, "*")


def closing_prices(w: Warehouse, start: datetime, end: datetime, opening: DataFrame | None) -> DataFrame:
    """The last price of each product before ``end``: of the window, or carried over from ``opening``."""
    prices = window_prices(w, start, end)
    if opening is not None:
        prices = prices.unionByName(opening.select(*PRICED, "date_time", "price"))
    last = prices.groupBy(*PRICED).agg(F.max(F.struct("date_time", "price")).alias("last"))
    return last.select(*PRICED, "last.date_time", "last.price")


def investor_timeline_recent(w: Warehouse, days: int = RECENT_DAYS) -> DataFrame:
    return priced_changes(w, w.as_of - timedelta(days=days), None)


def investor_timeline(
    w: Warehouse, history: DataFrame, cutover_days: int = CUTOVER_DAYS
) -> DataFrame:
    """Stored history before the cutover, the live view from it on."""
    merged = dedup_latest(history, TIMELINE_KEY, ["_version"]).drop("_version")
    recent = investor_timeline_recent(w)
    return union_at_cutover(merged, recent, "datetime", w.as_of - timedelta(days=cutover_days))
