"""Registered queries: every warehouse model over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans import coverage, dimensions, investor, prices, revenue, stats, zaps
from ledgerlens.plans.incremental import DERIVED, INCREMENTAL, run_chain, run_timeline, run_until, stored_rows
from ledgerlens.session import scratch_path
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, SHIP_AS_OF, warehouse, warehouse_at
from ledgerlens.workload.oracle_models import with_models
from ledgerlens.workload.present import present, select_sql

Build = Callable[[Warehouse], DataFrame]


@dataclass(frozen=True)
class Model:
    build: Build
    columns: tuple[str, ...]
    as_of: datetime = EVENTS_AS_OF

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.build(warehouse(spark, sf_dir, self.as_of)), self.columns)


def _words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def _numbers(*names: str) -> tuple[str, ...]:
    return tuple(f"{n}:d" for n in names)


_METRICS = tuple(
    {
        "breakdown_tokens": "breakdown_tokens:s",
        "breakdown_balances": "breakdown_balances:n",
        "underlying_balances": "underlying_balances:n",
    }.get(c, f"{c}:d")
    for c in stats.METRICS
)
_LATEST_METRICS = tuple(m for m in _METRICS if m.split(":")[0] in stats.LATEST_METRICS)
_ENTITY_HOUR = _words("chain_id:i product_address date_hour:t")
_CHAIN = (
    *_words("chain_id:i chain_name chain_key is_enabled date_hour:t"),
    *_numbers("tvl_usd", "vault_tvl_usd", "clm_tvl_usd", "avg_native_price", *stats.CHAIN_SUMS),
    *_numbers(*[f"avg_{c}" for c in stats.CHAIN_AVERAGES]),
    *[f"{c}_quantiles:q" for c in stats.CHAIN_AVERAGES],
)
_LISTED = _words(
    "chain_id:i product_key price_oracle_key display_name is_active creation_block:i "
    "creation_datetime:t declared_creation_date:t"
)
_TIMELINE = (
    *_words(
        "datetime:t account_id product_key product_display_name chain_id:i chain_name product_type "
        "product_address is_eol block_number:i transaction_hash log_index:i"
    ),
    *_numbers(
        "share_to_usd_price",
        "share_balance_after",
        "share_balance_before",
        "share_balance_diff",
        "usd_balance_before",
        "usd_balance_after",
        "usd_balance_diff",
    ),
)
_YIELD = (
    *_words("txn_timestamp:t chain_id:i product_address block_number:i txn_idx:i event_idx:i txn_hash"),
    *_numbers(*stats.YIELD_COLUMNS),
)
_LEGS = ("input", "output", "zap_fee", "refund")


def _history(w: Warehouse) -> DataFrame:
    return investor.investor_timeline_historical(w, datetime(2023, 12, 31))


def _timeline(w: Warehouse) -> DataFrame:
    return investor.investor_timeline(w, _history(w))


MODELS: dict[str, Model] = {
    "chain": Model(
        dimensions.chain,
        _words(
            "chain_id:i network_id:i chain_name chain_key is_enabled public_rpc_urls:s explorer_url "
            "multicall3_address ui_lens_address gas_type eol_date_time:t"
        ),
    ),
    "platform": Model(
        dimensions.platform, _words("platform_id platform_name website platform_type risks:s")
    ),
    "token": Model(
        dimensions.token,
        _words("chain_id:i representation_address erc20_address is_native symbol name decimals:i"),
    ),
    "product_classic": Model(
        dimensions.product_classic,
        (
            *_LISTED,
            *_words(
                "vault_address platform_id latest_strategy_address "
                "underlying_token_representation_address strategies_json"
            ),
        ),
    ),
    "product_clm": Model(
        dimensions.product_clm,
        (
            *_LISTED,
            *_words(
                "vault_address platform_id latest_strategy_address lp_token_representation_address "
                "underlying_token_representation_addresses:s strategies_json"
            ),
        ),
    ),
    "product_reward_pool": Model(
        dimensions.product_reward_pool,
        (
            *_LISTED,
            *_words(
                "reward_pool_address platform_id underlying_product_address "
                "reward_token_representation_addresses:s"
            ),
        ),
    ),
    "product_classic_boost": Model(
        dimensions.product_classic_boost,
        (
            *_LISTED,
            *_words(
                "boost_address underlying_token_representation_address reward_token_representation_address"
            ),
        ),
    ),
    "product": Model(
        dimensions.product, (*_LISTED, *_words("product_type product_address platform_id"))
    ),
    "product_bundle": Model(
        dimensions.product_bundle,
        _words(
            "chain_id:i bundle_root_product_address bundle_type is_active product_key display_name "
            "platform_id creation_block:i creation_datetime:t reward_pool_addresses:s classic_boost_addresses:s"
        ),
    ),
    "account": Model(
        dimensions.account,
        _words(
            "address labels:s is_contract active_chain_ids:s first_activity_timestamp:t "
            "last_activity_timestamp:t total_balance_changes:i unique_transactions:i unique_tokens:i"
        ),
    ),
    "indexed_chains": Model(coverage.indexed_chains, _words("network_id:i chain_id:i")),
    "int_price": Model(prices.int_price, _words("oracle_key date_time:t price:d")),
    "int_product_price": Model(
        prices.int_product_price, _words("chain_id:i token_address date_time:t price:d")
    ),
    "int_tvl": Model(stats.int_tvl, _words("chain_id:i product_address date_time:t tvl:d")),
    "int_yield": Model(stats.int_yield, _YIELD, SHIP_AS_OF),
    "tvl_hourly": Model(stats.tvl_hourly, (*_ENTITY_HOUR, "tvl_usd:d")),
    "apy_hourly": Model(stats.apy_hourly, (*_ENTITY_HOUR, "apy:d")),
    "apy_breakdown_hourly": Model(
        stats.apy_breakdown_hourly, (*_ENTITY_HOUR, *_numbers(*stats.BREAKDOWN))
    ),
    "lps_breakdown_hourly": Model(
        stats.lps_breakdown_hourly,
        (*_ENTITY_HOUR, *[m for m in _METRICS if m.split(":")[0] in stats.LP_COLUMNS]),
    ),
    "yield_hourly": Model(
        stats.yield_hourly, (*_ENTITY_HOUR, *_numbers(*stats.YIELD_COLUMNS)), SHIP_AS_OF
    ),
    "harvest_hourly": Model(
        stats.harvest_hourly, (*_ENTITY_HOUR, *_numbers(*stats.HARVEST_COLUMNS)), SHIP_AS_OF
    ),
    "unified_hourly": Model(stats.unified_hourly, (*_ENTITY_HOUR, "source", *_METRICS)),
    "product_stats": Model(
        stats.product_stats,
        (
            *_ENTITY_HOUR,
            *_words("chain_name product_type product_key display_name is_active platform_id"),
            *_METRICS,
        ),
    ),
    "product_stats_latest": Model(
        stats.product_stats_latest, (*_ENTITY_HOUR, *stats.LATEST_LABELS, *_LATEST_METRICS)
    ),
    "chain_stats": Model(stats.chain_stats, _CHAIN),
    "chain_stats_latest": Model(stats.chain_stats_latest, _CHAIN),
    "product_tvl_diff": Model(
        stats.product_tvl_diff,
        (
            *_words("chain_id:i product_address product_type product_key display_name is_active"),
            *_words("platform_id ref_hour:t tvl_usd_current:d"),
            *_numbers(*[f"tvl_usd_{p}_ago" for p in stats.PERIODS]),
            *_numbers(*[f"tvl_usd_diff_{p}" for p in stats.PERIODS]),
            *[f"rank_{p}_{side}:i" for p in stats.PERIODS for side in ("gainer", "loser")],
        ),
    ),
    "harvests": Model(
        revenue.harvests,
        (
            *_words("txn_timestamp:t chain_id:i product_address product_key product_type display_name"),
            *_words("block_number:i txn_idx:i event_idx:i txn_hash"),
            *_numbers(*[c for c in stats.HARVEST_COLUMNS if not c.endswith("_count")]),
        ),
        SHIP_AS_OF,
    ),
    "yield_harvest_events": Model(
        revenue.yield_harvest_events, (*_YIELD, "chain_name"), SHIP_AS_OF
    ),
    "revenue_buyback_events": Model(
        revenue.revenue_buyback_events,
        _words(
            "id txn_timestamp:t block_number:i event_idx:i txn_hash chain_id:i token_representation_address "
            "token_erc20_address token_is_native token_symbol token_name token_decimals:i token_price_usd:d "
            "buyback_amount:d buyback_usd:d"
        ),
        SHIP_AS_OF,
    ),
    "daily_revenue_summary": Model(
        revenue.daily_revenue_summary,
        _words("date_day:t yield_usd:d revenue_usd:d buyback_usd:d"),
        SHIP_AS_OF,
    ),
    "monthly_revenue": Model(
        revenue.monthly_revenue,
        _words("month:t yield_usd:d revenue_usd:d buyback_usd:d"),
        SHIP_AS_OF,
    ),
    "api_revenue_summary": Model(
        revenue.api_revenue_summary,
        _words("revenue_usd_30d:d yield_usd_7d:d buyback_usd_7d:d"),
        SHIP_AS_OF,
    ),
    "investor_timeline_historical": Model(_history, _TIMELINE),
    "investor_timeline_recent": Model(investor.investor_timeline_recent, _TIMELINE),
    "investor_timeline": Model(_timeline, _TIMELINE),
    "zap_activity": Model(
        zaps.zap_activity,
        (
            *_words("src_chain_id:i src_chain_name src_chain_key src_chain_is_enabled src_txn_hash"),
            *_words("src_block_number:i src_txn_idx:i src_txn_timestamp:t src_txn_date:t dst_chain_id:i"),
            *_words("dst_chain_name dst_chain_key dst_chain_is_enabled is_same_chain_zap caller_address"),
            *_words("caller_labels:s caller_is_contract recipient_address recipient_labels:s"),
            *_words("recipient_is_contract product_key action actions:s flow_direction"),
            *_numbers("total_usd", "signed_usd", *[f"{leg}_usd" for leg in _LEGS]),
            *[f"{leg}_{c}:s" for leg in _LEGS for c in ("token_addresses", "token_symbols")],
            *[f"{leg}_{c}:n" for leg in _LEGS for c in ("token_amounts", "usd_values")],
            *_words("success gas_used:i native_price:d from_address to_address bridge_hash swap_source:s event_count:i"),
        ),
    ),
    "missing_products_in_index": Model(
        coverage.missing_products_in_index,
        _words(
            "chain_id:i chain_name product_address product_key display_name is_active "
            "declared_creation_date:t missing_in_model"
        ),
    ),
}


#: Reference times of the runs that load a model: two early ones, then the last one twice. Each run goes a day back.
RUNS: dict[str, list[datetime]] = {
    "int_yield": [datetime(1996, 1, 1), datetime(1999, 1, 1), datetime(2100, 1, 1), datetime(2100, 1, 1)],
    "tvl_hourly": [datetime(2024, 1, 9), datetime(2024, 1, 20), datetime(2100, 1, 1), datetime(2100, 1, 1)],
    "apy_hourly": [datetime(2024, 1, 9), datetime(2024, 1, 20), datetime(2100, 1, 1), datetime(2100, 1, 1)],
}


def _in_runs(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The model as a table that scheduled runs have loaded piece by piece."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"incremental-{name}")
        rows = run_until(warehouse(spark, sf_dir), INCREMENTAL[name], path, RUNS[name])
        return present(rows, MODELS[name].columns)

    return run


#: Scheduled runs of the hourly table and its followers; rows arrive up to 21 hours late. The last run finds nothing new.
CHAIN_RUNS = [datetime(1997, 6, 1), datetime(2024, 1, 15), datetime(2024, 2, 2), datetime(2024, 2, 2)]
_CHAINS: dict[tuple[str, str], str] = {}


def chain_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables that the runs of ``CHAIN_RUNS`` leave, made once per session and driver folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHAINS:
        root = scratch_path(spark, "chain")
        for at in CHAIN_RUNS:
            run_chain(warehouse_at(spark, sf_dir, at), root)
        _CHAINS[key] = root
    return _CHAINS[key]


def _in_chain(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The table of a model after the runs, each of which recomputed only what had changed before it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(stored_rows(warehouse(spark, sf_dir), f"{chain_root(spark, sf_dir)}/{name}"), MODELS[name].columns)

    return run


def _timeline_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical timeline loaded in catch-up windows that carry closing prices over."""
    w, path = warehouse(spark, sf_dir), scratch_path(spark, "timeline")
    while run_timeline(w, path, datetime(2023, 11, 8), carry=True):
        pass
    return present(stored_rows(w, path).drop("_version"), MODELS["investor_timeline_historical"].columns)


IN_CHAIN = ("unified_hourly", *DERIVED)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f"model_{name}": model.run for name, model in MODELS.items()}
    found |= {f"inc_model_{name}": _in_runs(name) for name in RUNS}
    found |= {f"inc_model_{name}": _in_chain(name) for name in IN_CHAIN}
    return found | {"inc_model_investor_timeline_historical": _timeline_in_windows}


def oracles() -> dict[str, str]:
    answers = {name: with_models(select_sql(name, model.columns)) for name, model in MODELS.items()}
    return {f"model_{name}": sql for name, sql in answers.items()} | {
        f"inc_model_{name}": answers[name] for name in (*RUNS, *IN_CHAIN, "investor_timeline_historical")
    }
