"""Harvest, buyback and revenue marts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.joins import join_every_match
from ledgerlens.operators.rollup import daily_totals
from ledgerlens.plans.dimensions import chain, token
from ledgerlens.plans.staging import staging
from ledgerlens.plans.stats import int_yield, product_harvests
from ledgerlens.sources.catalog import Warehouse


def harvests(w: Warehouse) -> DataFrame:
    """One row per usable harvest with its fees in coin and USD."""
    native = F.col("native_price")

    def usd(amount: str):
        return fn.usd_value(F.col(amount), native)

    return w.model(product_harvests).select(
        "txn_timestamp",
        "chain_id",
        "product_address",
        "product_key",
        "product_type",
        "display_name",
        "block_number",
        "txn_idx",
        "event_idx",
        "txn_hash",
        F.col("call_fee").alias("harvest_call_fee"),
        usd("call_fee").alias("harvest_call_fee_usd"),
        "gas_fee",
        usd("gas_fee").alias("gas_fee_usd"),
        "platform_fee",
        usd("platform_fee").alias("platform_fee_usd"),
        "strategist_fee",
        usd("strategist_fee").alias("strategist_fee_usd"),
        "harvest_amount",
        fn.usd_value(F.col("harvest_amount"), F.col("want_price")).alias("harvest_amount_usd"),
        native.alias("avg_native_price"),
    )


def yield_harvest_events(w: Warehouse) -> DataFrame:
    chains = w.model(chain).select("chain_id", "chain_name")
    return w.model(int_yield).join(chains, "chain_id")


def revenue_buyback_events(w: Warehouse) -> DataFrame:
    """Buybacks paired with every chain's row of the bought token."""
    buybacks = staging(w, "db_token_buyback").select(
        "id",
        "txn_timestamp",
        "block_number",
        "event_idx",
        "txn_hash",
        F.col("token_price").alias("token_price_usd"),
        F.col("token_amount").alias("buyback_amount"),
        fn.usd_value(F.col("token_amount"), F.col("token_price")).alias("buyback_usd"),
    )
    tokens = w.model(token).where(F.col("symbol") == w.buyback_symbol).select(
        "chain_id",
        F.col("representation_address").alias("token_representation_address"),
        F.col("erc20_address").alias("token_erc20_address"),
        F.col("is_native").alias("token_is_native"),
        F.col("symbol").alias("token_symbol"),
        F.col("name").alias("token_name"),
        F.col("decimals").alias("token_decimals"),
    )
    return join_every_match(buybacks, tokens, ["id"])


def daily_revenue_summary(w: Warehouse) -> DataFrame:
    """Yield, treasury revenue and token buybacks per day."""
    buybacks = staging(w, "db_token_buyback")
    return daily_totals(
        {
            "yield_usd": (
                w.model(int_yield),
                "txn_timestamp",
                F.col("underlying_amount_compounded_usd"),
            ),
            "revenue_usd": (
                staging(w, "db_feebatch_harvests"),
                "txn_timestamp",
                F.col("treasury_amt"),
            ),
            "buyback_usd": (
                buybacks,
                "txn_timestamp",
                fn.usd_value(F.col("token_amount"), F.col("token_price")),
            ),
        }
    )


def monthly_revenue(w: Warehouse) -> DataFrame:
    """The dashboard's monthly trend."""
    return w.model(daily_revenue_summary).groupBy(fn.month_of(F.col("date_day")).alias("month")).agg(
        *[F.sum(c).alias(c) for c in ("yield_usd", "revenue_usd", "buyback_usd")]
    )


def api_revenue_summary(w: Warehouse) -> DataFrame:
    """One row: 30-day revenue, 7-day yield, 7-day buybacks."""
    today = w.as_of.date()
    day = F.col("date_day")
    month, week = F.lit(today - timedelta(days=30)), F.lit(today - timedelta(days=7))
    return w.model(daily_revenue_summary).where(day >= month).agg(
        F.sum("revenue_usd").cast("double").alias("revenue_usd_30d"),
        F.sum(F.when(day >= week, F.col("yield_usd"))).cast("double").alias("yield_usd_7d"),
        F.sum(F.when(day >= week, F.col("buyback_usd"))).cast("double").alias("buyback_usd_7d"),
    )
