"""Staging: one typed, cleaned view per raw table.

Plain models are rows of ``SPECS``: (output column, raw column, kind), where the
kind names a rule of ``RULES``. Models with logic of their own follow below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.filters import after_epoch, drop_listed, scoped_exclusion
from ledgerlens.operators.merge import dedup_latest, latest_load
from ledgerlens.sources.catalog import Warehouse

RULES: dict[str, Callable[[Column], Column]] = {
    "as_is": lambda c: c,
    "string": lambda c: c.cast("string"),
    "bigint": lambda c: c.try_cast("bigint"),
    "int": lambda c: c.try_cast("int"),
    "double": lambda c: c.try_cast("double"),
    "bool": lambda c: c.cast("boolean"),
    "flag": lambda c: fn.bool_or(c),
    "time": lambda c: c.cast("timestamp_ntz"),
    "iso_time": fn.iso_timestamp,
    "unix_time": fn.unix_timestamp_or_null,
    "decimal": fn.to_decimal,
    "decimal_or_zero": fn.decimal_or_zero,
    "millionths": lambda c: fn.scaled_integer(c, 6),
    "lower": fn.lower_hash,
    "network": fn.network_key,
    "text_or_unknown": fn.default_text,
    "null_if_empty": lambda c: F.nullif(c, F.lit("")),
    "string_list": fn.json_string_list,
    "address_list": lambda c: fn.address_list(fn.json_string_list(c)),
    "decimal_list": lambda c: fn.decimal_list(fn.json_string_list(c)),
    "list_text": lambda c: F.coalesce(c, F.lit("[]")),
    "trimmed_bigint": fn.safe_bigint,
    "nonzero": lambda c: c.try_cast("bigint") != 0,
}

Spec = list[tuple[str, str, str]]


def _same(kind: str, *names: str) -> Spec:
    return [(name, name, kind) for name in names]


_INDEXED: Spec = [
    *_same("as_is", "id"),
    ("network_id", "chainId", "bigint"),
    *_same("lower", "address"),
    ("share_token_id", "shareToken_id", "as_is"),
    ("underlying_token_id", "underlyingToken_id", "as_is"),
    ("initializable_status", "initializableStatus", "as_is"),
    ("initialized_block", "initializedBlock", "bigint"),
    ("initialized_timestamp", "initializedTimestamp", "time"),
]


def _strategy(parent: str, raw_parent: str) -> Spec:
    # Blocks stay text here; the product models decide which strategies are usable.
    return [
        *_same("as_is", "id"),
        ("network_id", "chainId", "bigint"),
        *_same("lower", "address"),
        (parent, raw_parent, "as_is"),
        ("initializable_status", "initializableStatus", "as_is"),
        ("initialized_block", "initializedBlock", "string"),
        ("initialized_timestamp", "initializedTimestamp", "time"),
    ]


_LISTING = _same(
    "as_is",
    "assets",
    "risks",
    "point_structure_ids",
    "zaps",
    "token",
    "token_provider_id",
    "earned_token",
    "oracle",
    "oracle_id",
    "status",
    "created_at",
    "strategy_type_id",
    "type",
    "last_harvest",
    "retire_reason",
    "retired_at",
    "updated_at",
)

SPECS: dict[str, Spec] = {
    # Snapshots of the public API.
    "api_apy": [
        *_same("double", "apy"),
        *_same("string", "etag", "vault_id"),
        *_same("time", "date_time"),
        ("apy_raw", "apy__raw", "as_is"),
    ],
    "api_apy_breakdown": [
        *_same("bigint", "compoundings_per_year"),
        *_same(
            "double",
            "performance_fee",
            "lp_fee",
            "total_apy",
            "vault_apr",
            "trading_apr",
            "clm_apr",
            "reward_pool_apr",
            "reward_pool_trading_apr",
            "vault_apy",
            "liquid_staking_apr",
            "composable_pool_apr",
            "merkl_apr",
            "linea_ignition_apr",
        ),
        *_same("string", "etag", "vault_id"),
        *_same("time", "date_time"),
    ],
    "api_lps": [
        *_same("string", "etag", "vault_id"),
        *_same("double", "lps"),
        *_same("time", "date_time"),
    ],
    "api_lps_breakdown": [
        *_same("string", "etag", "vault_id"),
        *_same("time", "date_time"),
        *_same("double", "price"),
        *_same("address_list", "tokens"),
        *_same("decimal_list", "balances"),
        *_same("decimal", "total_supply", "underlying_liquidity"),
        *_same("decimal_list", "underlying_balances"),
        *_same("decimal", "underlying_price"),
    ],
    "api_share_token_prices": [
        *_same("string", "etag", "chain_id"),
        *_same("text_or_unknown", "share_token_symbol"),
        *_same("double", "price"),
        *_same("time", "date_time"),
    ],
    "api_prices": [
        *_same("string", "etag"),
        *_same("as_is", "token_symbol"),
        *_same("double", "price"),
        *_same("time", "date_time"),
    ],
    "api_tvl": [
        *_same("string", "etag"),
        *_same("bigint", "network_id"),
        *_same("string", "vault_id"),
        *_same("double", "tvl"),
        *_same("time", "date_time"),
    ],
    "api_treasury": [
        *_same("as_is", "token_decimals", "token_price", "usd_value"),
        *_same("string", "etag", "chain_id", "wallet_address"),
        *_same("as_is", "wallet_name"),
        *_same("lower", "token_address"),
        *_same("time", "date_time"),
        *_same(
            "as_is",
            "name",
            "address",
            "decimals",
            "asset_type",
            "oracle_id",
            "oracle_type",
            "symbol",
            "price",
            "balance",
            "id",
        ),
        *_same("bool", "staked"),
        *_same(
            "as_is",
            "number_id",
            "method",
            "method_path",
            "vault_id",
            "price_per_full_share",
            "helper",
        ),
    ],
    "api_treasury_mm": [
        *_same("as_is", "price", "usd_value", "balance"),
        *_same("string", "etag", "mm_id"),
        *_same("as_is", "exchange_name", "token_symbol"),
        *_same("time", "date_time"),
        *_same("as_is", "symbol", "name", "oracle_id", "oracle_type"),
    ],
    # API listings.
    "api_vaults": [
        *_LISTING,
        *_same("as_is", "migration_ids", "add_liquidity_url", "remove_liquidity_url"),
        *_same("string", "id"),
        *_same("text_or_unknown", "name"),
        *_same("lower", "token_address", "earn_contract_address", "earned_token_address"),
        *_same("int", "token_decimals"),
        *_same("string", "platform_id"),
        *_same("network", "network"),
        *_same("bool", "is_gov_vault"),
        *_same("lower", "strategy"),
        *_same(
            "as_is",
            "price_per_full_share",
            "buy_token_url",
            "lending_oracle",
            "paused_at",
            "curator_id",
            "underlying_platform_url",
            "deposit_fee",
            "pause_reason",
        ),
        *_same("bool", "refund"),
        *_same("lower", "refund_contract_address"),
        *_same("bool", "show_warning"),
        *_same("as_is", "warning"),
        *_same("bool", "earning_points"),
        *_same("as_is", "pool_together", "retired_reason", "bridged"),
    ],
    "api_clm_vaults": [
        *_LISTING,
        *_same("as_is", "fee_tier", "vault", "pool", "chain", "token_decimals"),
        *_same("string_list", "deposit_token_addresses"),
        *_same("string", "id"),
        *_same("text_or_unknown", "name"),
        *_same("lower", "token_address", "earned_token_address", "earn_contract_address"),
        *_same("string", "platform_id"),
        *_same("network", "network"),
        *_same("bool", "is_gov_vault"),
        *_same("lower", "strategy"),
        *_same("bool", "earning_points"),
    ],
    "api_gov_vaults": [
        *_LISTING,
        *_same("as_is", "earned_oracle_ids", "earned_tokens", "earned_token_decimals"),
        *_same("string_list", "earned_token_addresses"),
        *_same("string", "id"),
        *_same("text_or_unknown", "name"),
        *_same("int", "version", "token_decimals"),
        *_same("lower", "token_address", "earn_contract_address", "earned_token_address"),
        *_same("string", "platform_id"),
        *_same("network", "network", "chain"),
        *_same("bool", "is_gov_vault"),
        *_same("as_is", "total_supply", "excluded", "buy_token_url", "earning_points"),
        ("earned_token_decimals_raw", "earned_token_decimals__raw", "as_is"),
    ],
    "api_legacy_clm_vaults": [
        *_LISTING,
        *_same(
            "as_is",
            "deposit_token_addresses",
            "name",
            "token_address",
            "token_decimals",
            "earned_token_address",
            "earn_contract_address",
            "platform_id",
            "network",
            "fee_tier",
            "chain",
            "strategy",
        ),
        *_same("string", "id"),
        *_same("bool", "is_gov_vault", "earning_points"),
    ],
    "api_boosts": [
        *_same("as_is", "assets", "partners", "period_finishes"),
        *_same("string", "id"),
        *_same("as_is", "name", "chain", "pool_id", "version", "status"),
        ("boost_contract_address", "earn_contract_address", "lower"),
        ("underlying_token_address", "token_address", "lower"),
        *_same("as_is", "earned_token", "earned_token_decimals"),
        ("reward_token_address", "earned_token_address", "lower"),
        *_same("as_is", "earned_oracle", "earned_oracle_id", "partnership"),
        *_same("bool", "is_share_staked"),
        *_same("as_is", "period_finish", "campaign"),
    ],
    "api_tokens": [
        *_same("as_is", "type"),
        *_same("string", "id"),
        *_same("text_or_unknown", "symbol", "name"),
        ("chain_key", "chain_id", "network"),
        *_same("as_is", "oracle", "oracle_id"),
        *_same("lower", "address"),
        *_same("bigint", "decimals"),
        *_same("as_is", "bridge"),
        *_same("bool", "staked"),
    ],
    "api_loads": [
        *_same("as_is", "load_id", "schema_name", "status"),
        *_same("time", "inserted_at"),
        *_same("as_is", "schema_version_hash"),
    ],
    # Tables of the protocol database.
    "db_address_metadata": [
        ("network_id", "chain_id", "bigint"),
        *_same("lower", "address"),
        *_same("bool", "is_contract"),
        *_same("null_if_empty", "label"),
    ],
    "db_apys": [
        *_same("string", "vault_id"),
        ("date_time", "t", "time"),
        ("apy", "val", "double"),
        ("raw_date_time", "t", "as_is"),
    ],
    "db_tvls": [
        *_same("string", "vault_id"),
        ("date_time", "t", "time"),
        ("tvl_usd", "val", "double"),
    ],
    "db_token_buyback": [
        *_same("string", "id"),
        *_same("bigint", "block_number"),
        *_same("time", "txn_timestamp"),
        *_same("bigint", "event_idx"),
        *_same("lower", "txn_hash"),
        *_same("decimal", "token_amount", "token_price", "buyback_total"),
    ],
    "db_chains": [
        ("network_id", "chain_id", "bigint"),
        *_same("text_or_unknown", "name", "short_name"),
        *_same("nonzero", "enabled"),
    ],
    "db_feebatch_harvests": [
        *_same("string", "row_id", "chain_id"),
        *_same("bigint", "block_number"),
        *_same("time", "txn_timestamp"),
        *_same("lower", "txn_hash"),
        *_same(
            "decimal", "harvest_usd", "treasury_amt", "rewardpool_amt", "native_price", "stable_price"
        ),
    ],
    "db_harvests": [
        ("network_id", "chain_id", "bigint"),
        *_same("bigint", "block_number"),
        *_same("int", "txn_idx", "event_idx"),
        *_same("time", "txn_timestamp"),
        *_same("lower", "txn_hash"),
        ("product_key", "vault_id", "string"),
        *_same("decimal_or_zero", "call_fee"),
        ("raw_gas_fee", "gas_fee", "decimal_or_zero"),
        *_same(
            "decimal_or_zero",
            "platform_fee",
            "strategist_fee",
            "harvest_amount",
            "native_price",
            "want_price",
        ),
        *_same("flag", "is_keeper_call"),
        *_same("lower", "strategist_address"),
    ],
    "db_price_oracles": [*_same("string", "id", "oracle_id"), *_same("list_text", "tokens")],
    "db_prices": [
        *_same("string", "oracle_id"),
        *_same("time", "t"),
        *_same("decimal", "val"),
    ],
    "db_tvl_by_chain": [
        ("network_id", "chain_id", "bigint"),
        ("date_time", "t", "time"),
        ("tvl_usd", "total", "decimal"),
        ("vault_tvl_usd", "vault", "decimal"),
        ("gov_tvl_usd", "gov", "decimal"),
        ("clm_tvl_usd", "clm", "decimal"),
    ],
    "db_vault_ids": [("vault_id", "id", "string"), ("product_key", "vault_id", "as_is")],
    "db_vault_strategies": [
        *_same("string", "id", "chain_id"),
        *_same("bigint", "block_number"),
        *_same("lower", "txn_hash"),
        *_same("string", "vault_id"),
        *_same("lower", "vault_address", "strategy_address"),
    ],
    "db_zap_parent_transactions": [
        ("network_id", "chain_id", "bigint"),
        *_same("bigint", "block_number"),
        *_same("int", "txn_idx"),
        *_same("time", "txn_timestamp"),
        *_same("lower", "txn_hash"),
        *_same("decimal_or_zero", "value"),
        *_same("bigint", "effective_gas_price", "gas_limit", "gas_used"),
        *_same("decimal_or_zero", "native_price"),
        *_same("lower", "from_address", "to_address"),
        *_same("string", "calldata"),
        *_same("bool", "success"),
        *_same("time", "created_at"),
    ],
    "db_zap_records": [
        ("network_id", "chain_id", "bigint"),
        *_same("bigint", "block_number"),
        *_same("int", "txn_idx", "event_idx"),
        *_same("lower", "txn_hash", "caller_address", "recipient_address"),
        ("source_network_id", "source_chain_id", "bigint"),
        ("target_network_id", "target_chain_id", "bigint"),
        ("product_key", "vault_id", "string"),
        *_same("string", "action"),
        *_same("decimal_or_zero", "total_usd"),
        *_same("lower", "bridge_hash"),
        *_same("string_list", "swap_source"),
        *_same("time", "created_at", "updated_at"),
    ],
    "db_zap_token_transfers": [
        ("network_id", "chain_id", "bigint"),
        *_same("bigint", "block_number"),
        *_same("int", "txn_idx", "parent_event_idx", "event_idx"),
        *_same("string", "zap_type"),
        *_same("bigint", "token_id"),
        *_same("decimal_or_zero", "token_amount", "usd_value"),
        *_same("lower", "token_address"),
        *_same("time", "created_at", "updated_at"),
    ],
    # Cross-chain bridge feed.
    "bridge_messages": [
        *_same("trimmed_bigint", "src_network_id"),
        *_same("lower", "src_tx_hash"),
        *_same("bigint", "src_log_index"),
        *_same("time", "updated_at", "created_at"),
        *_same("trimmed_bigint", "src_block_number"),
        *_same("as_is", "src_block_hash"),
        *_same("string", "src_block_timestamp"),
        *_same("as_is", "src_message"),
        *_same("lower", "src_sender", "src_burn_token"),
        ("src_burn_amount_usdc", "src_burn_amount", "millionths"),
        *_same("as_is", "attestation_message", "attestation", "attestation_nonce"),
        *_same("bigint", "attestation_version"),
        *_same("as_is", "attestation_status", "lifecycle_state"),
        *_same("trimmed_bigint", "dst_network_id"),
        *_same("lower", "dst_receiver", "dst_recipient", "dst_tx_hash", "dst_tx_caller"),
        *_same("bigint", "dst_log_index"),
        *_same("trimmed_bigint", "dst_block_number"),
        *_same("string", "dst_block_timestamp"),
        *_same("bigint", "dst_relay_attempts"),
        *_same("flag", "dst_zap_success"),
        ("dst_amount_in_usdc", "dst_amount_in", "millionths"),
        ("dst_refunded_amount_usdc", "dst_refunded_amount", "millionths"),
        ("dst_recovered_amount_usdc", "dst_recovered_amount", "millionths"),
        *_same("as_is", "error_code", "error_message"),
    ],
    # Configuration files.
    "files_platforms": [
        *_same("string", "id"),
        *_same("text_or_unknown", "name"),
        *_same("as_is", "website", "twitter", "documentation", "description", "type"),
        *_same("string_list", "risks"),
    ],
    # Chain indexer.
    "idx_account": [*_same("as_is", "id"), *_same("lower", "address")],
    "idx_classic_boost": _INDEXED,
    "idx_classic_vault": _INDEXED,
    "idx_classic_vault_strategy": _strategy("classic_vault_id", "classicVault_id"),
    "idx_clm_manager": [
        *[row for row in _INDEXED if row[0] != "underlying_token_id"],
        ("underlying_token0_id", "underlyingToken0_id", "as_is"),
        ("underlying_token1_id", "underlyingToken1_id", "as_is"),
    ],
    "idx_clm_strategy": _strategy("clm_manager_id", "clmManager_id"),
    "idx_contract_registry": [
        *_same("as_is", "id"),
        ("network_id", "chain_id", "bigint"),
        *_same(
            "as_is",
            "registering_event_block_number",
            "registering_event_log_index",
            "registering_event_block_timestamp",
            "registering_event_contract_name",
            "registering_event_name",
        ),
        *_same("lower", "registering_event_src_address", "contract_address"),
        *_same("as_is", "contract_name"),
    ],
    "idx_erc4626_adapter": _INDEXED,
    "idx_lst_vault": _INDEXED,
    "idx_pool_rewarded_event": [
        *_same("as_is", "id"),
        ("network_id", "chainId", "bigint"),
        ("trx_hash", "trxHash", "lower"),
        ("log_index", "logIndex", "as_is"),
        ("block_number", "blockNumber", "bigint"),
        ("block_timestamp", "blockTimestamp", "time"),
        ("pool_share_token_id", "poolShareToken_id", "as_is"),
        ("reward_token_id", "rewardToken_id", "as_is"),
        ("reward_amount", "rewardAmount", "as_is"),
        ("reward_vesting_seconds", "rewardVestingSeconds", "as_is"),
    ],
    "idx_reward_pool": _INDEXED,
    "idx_token": [
        *_same("as_is", "id"),
        ("network_id", "chainId", "bigint"),
        ("is_virtual", "isVirtual", "as_is"),
        *_same("lower", "address"),
        *_same("as_is", "symbol", "name", "decimals"),
        ("total_supply", "totalSupply", "as_is"),
        ("holder_count", "holderCount", "as_is"),
    ],
    "idx_token_balance": [
        *_same("as_is", "id"),
        ("network_id", "chainId", "bigint"),
        *_same("as_is", "account_id", "token_id", "amount"),
    ],
}


def stage(df: DataFrame, spec: Spec) -> DataFrame:
    """Applies a spec; raw columns the feed never sent become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            RULES[kind](F.col(f"`{raw}`") if raw in have else F.lit(None).cast("string")).alias(out)
            for out, raw, kind in spec
        ]
    )


#: Number of the load that brought a raw row; later loads have greater ones.
LOAD = "_load_seq"
#: Tables whose rows are loaded again, with the key that a row is loaded again by. A harvest's time is that of its
#: block, so it belongs to the key and lets bounds on time reach the scan.
RELOADED = {
    "db_apys": ["vault_id", "t"],
    "db_tvls": ["vault_id", "t"],
    "db_prices": ["oracle_id", "t"],
    "db_tvl_by_chain": ["chain_id", "t"],
    "db_harvests": ["chain_id", "block_number", "txn_idx", "event_idx", "txn_timestamp"],
}


def last_loaded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One raw row per key: that of the last load, whatever its values.

    Rows of one load that share a key take the greatest columns, as do all rows of a
    table without load numbers.
    """
    if LOAD not in rows.columns:
        return dedup_latest(rows, keys, [], combine=False)
    return dedup_latest(rows, keys, [LOAD], combine=False).drop(LOAD)


def staged(w: Warehouse, name: str) -> DataFrame:
    """The plain staging model of a raw table."""
    rows = w.table(name)
    return stage(last_loaded(rows, RELOADED[name]) if name in RELOADED else rows, SPECS[name])


def api_apy(w: Warehouse) -> DataFrame:
    return staged(w, "api_apy").where(F.col("apy").isNotNull())


def api_share_token_prices(w: Warehouse) -> DataFrame:
    return staged(w, "api_share_token_prices").where(F.col("price").isNotNull())


def api_tokens(w: Warehouse) -> DataFrame:
    return staged(w, "api_tokens").where(F.col("chain_key").isNotNull())


def api_clm_vaults(w: Warehouse) -> DataFrame:
    """Only the newest load per chain and earned token, as entity ids get corrected and reloaded."""
    raw = latest_load(
        w.table("api_clm_vaults"),
        staged(w, "api_loads"),
        {"chain": F.col("chain"), "token": F.lower("earned_token_address")},
    )
    return stage(raw, SPECS["api_clm_vaults"])


def api_gov_vaults(w: Warehouse) -> DataFrame:
    """Only the newest load per normalized chain and contract."""
    raw = latest_load(
        w.table("api_gov_vaults"),
        staged(w, "api_loads"),
        {"chain": fn.network_key(F.col("chain")), "contract": F.lower("earn_contract_address")},
    )
    return stage(raw, SPECS["api_gov_vaults"])


def files_ui_chains(w: Warehouse) -> DataFrame:
    raw = w.table("files_ui_chains")
    native, gas = F.col("native"), F.col("gas")
    return raw.select(
        F.col("chain_id").try_cast("bigint").alias("network_id"),
        fn.default_text(F.col("name")).alias("name"),
        F.col("chain_key").cast("string").alias("chain_key"),
        fn.json_string_list(F.col("rpc")).alias("rpc"),
        F.col("explorer_url"),
        F.lower("multicall3_address").alias("multicall3_address"),
        F.lower("app_multicall_contract_address").alias("app_multicall_contract_address"),
        fn.json_field(native, "symbol").alias("native_token_symbol"),
        fn.json_field(native, "oracleId").alias("native_token_oracle_id"),
        fn.json_field(native, "decimals").try_cast("bigint").alias("native_token_decimals"),
        fn.json_field(gas, "type").alias("gas_type"),
        fn.unix_timestamp_or_null(F.col("eol")).alias("eol_date_time"),
        F.col("disabled").cast("boolean").alias("ui_disabled"),
        F.col("new").cast("boolean").alias("ui_new"),
    )


def db_token_buyback(w: Warehouse) -> DataFrame:
    return staged(w, "db_token_buyback").where(
        F.col("buyback_total").isNotNull()
        & (F.col("token_amount") > 0)
        & (F.col("token_price") > 0)
        & after_epoch(F.col("txn_timestamp"))
    )


def db_feebatch_harvests(w: Warehouse) -> DataFrame:
    return staged(w, "db_feebatch_harvests").where(
        (F.col("treasury_amt") > 0) & after_epoch(F.col("txn_timestamp"))
    )


# Harvests above this USD value are pricing errors.
HARVEST_USD_CAP = 30_000_000

# Transactions known to carry wrong harvest amounts or prices,
# as (network id, transaction hash).
WRONG_HARVESTS = [
    (43114, "0xfd904cb8742ea0caa10bc8a1475f487a2af885938997ff00dcbc195533961162"),
    (43114, "0xffe824f13634da2f10daedb3c3cc123fea419e1b03fb6d169e9a98c89a29100e"),
    (43114, "0x058d86ee2e888dbbf3bcbd20adc71739e6d29feae0074a944dfaad6a892384c3"),
    (43114, "0x83a4b2356d4d18228d02755ddd13a5b6f932fa8a611620580b6ed8d04320c021"),
    (10, "0x079606a933abf8dce650c09da15a065afca30fa34e8c3aa714205d63015031a2"),
    (10, "0x5d0538d3c5888cfa803329410df043a289f8cca32563c497e8b9ba835d28a3c7"),
    (10, "0xf5db5dff133fee010a2ee689f1fd62a2fb9879d9e34533028daa641ab05a2c4b"),
    (1, "0xec308aaa41bea030e06de958af46179803f96c3c78950b8da2c4912a1775d87a"),
    (1, "0x31b8083e467ed217523655f9b26b71f154fd1358e633b275011123c268a88901"),
    (1, "0x06163765e870e2adfbe047560c62162a9aab772007b313ea2c96827c4277d1d1"),
    (43114, "0x091c7e4427dedf0c35bf327f2a7d88541667b322036d8935a8e7c276d7a66091"),
    (8453, "0x2d27615057903b479a5c2ba5c2c7a85633563bf36074ac918c6b8c4eaf3f4cc0"),
    (8453, "0xb19cb06de752f37fb548e91f23b0e7fbd94a27bcbb2952c10c431a57694519de"),
    (1, "0x89f2671d3eb48c92a84b166a45dff8c298fc6f695486eab1e5dfb0c8b4e70894"),
    (1, "0x6204006c62510f6b268e799f506fef765187708478e9352bcef08eddcf785d50"),
    (1, "0x3d8fdd022db3ed7737dd980e35accf9717b285e751bdde2a9469b7d099079ef7"),
    (1, "0x38d21589995e4a397b711ef4f4c7dbe7220c45cb2c56bd3cc9d3022271678d48"),
    (1, "0x1a19f3cfea8ec410ed88c9b249ab8550b22ca8d1969dbb31d8a395ce3ea776a3"),
]

# One product was mispriced for a week.
MISPRICED = ("pendle-eqb-arb-ausdc-26jun25", "2024-12-18", "2024-12-24", 10_000)


def db_harvests(w: Warehouse) -> DataFrame:
    """Usable harvests: positive amount and price, plausible USD value, not on a deny list.

    Gas is recorded in the smallest coin unit and scaled to whole coins.
    """
    amount, price = F.col("harvest_amount"), F.col("want_price")
    key, start, end, above = MISPRICED
    rows = (
        staged(w, "db_harvests")
        .withColumn("gas_fee", fn.whole_coins(F.col("raw_gas_fee")))
        .where(
            F.col("txn_timestamp").isNotNull()
            & (F.col("harvest_amount") > 0)
            & (F.col("want_price") > 0)
            & fn.usd_below(amount, price, HARVEST_USD_CAP)
            & ~scoped_exclusion(
                F.col("product_key"),
                key,
                F.col("txn_timestamp"),
                start,
                end,
                F.try_multiply(amount, price),
                above,
            )
        )
    )
    return drop_listed(rows, WRONG_HARVESTS, ["network_id", "txn_hash"])


def db_tvl_by_chain(w: Warehouse) -> DataFrame:
    """One row per chain and time, without one known spike."""
    rows = staged(w, "db_tvl_by_chain")
    # Network, period and threshold of the spike.
    spike = scoped_exclusion(
        F.col("network_id"),
        1,
        F.col("date_time"),
        "2024-04-03",
        "2024-04-04",
        F.col("tvl_usd"),
        8_000_000_000,
    )
    return rows.where(~spike)


def bridge_messages(w: Warehouse) -> DataFrame:
    """Latest state of each message; the feed repeats rows at its cursor."""
    return dedup_latest(
        staged(w, "bridge_messages"),
        ["src_network_id", "src_tx_hash", "src_log_index"],
        ["updated_at"],
    )


def idx_token_balance_change(w: Warehouse) -> DataFrame:
    """Balance changes with the token address taken from the ``<chain>-<address>`` token id."""
    before = fn.to_decimal(F.col("balanceBefore"))
    after = fn.to_decimal(F.col("balanceAfter"))
    address = fn.split_part(F.col("token_id"), "-", 1)
    return w.table("idx_token_balance_change").select(
        "id",
        F.col("chainId").cast("bigint").alias("chain_id"),
        F.col("chainId").cast("bigint").alias("network_id"),
        F.col("tokenBalance_id").alias("token_balance_id"),
        "account_id",
        "token_id",
        F.lower("trxHash").alias("trx_hash"),
        F.col("logIndex").cast("int").alias("log_index"),
        F.col("blockNumber").cast("bigint").alias("block_number"),
        fn.naive(F.col("blockTimestamp")).alias("block_timestamp"),
        before.alias("balance_before"),
        after.alias("balance_after"),
        fn.representation_address(address).alias("token_contract_address"),
        F.try_subtract(after, before).try_cast(fn.AMOUNT).alias("share_diff"),
    )


LOGIC = {
    "api_apy": api_apy,
    "api_share_token_prices": api_share_token_prices,
    "api_tokens": api_tokens,
    "api_clm_vaults": api_clm_vaults,
    "api_gov_vaults": api_gov_vaults,
    "files_ui_chains": files_ui_chains,
    "db_token_buyback": db_token_buyback,
    "db_feebatch_harvests": db_feebatch_harvests,
    "db_harvests": db_harvests,
    "db_tvl_by_chain": db_tvl_by_chain,
    "bridge_messages": bridge_messages,
    "idx_token_balance_change": idx_token_balance_change,
}


def staging(w: Warehouse, name: str) -> DataFrame:
    """Any staging model by name."""
    return w.model(LOGIC[name]) if name in LOGIC else staged(w, name)


MODEL_NAMES = sorted({*SPECS, *LOGIC})
