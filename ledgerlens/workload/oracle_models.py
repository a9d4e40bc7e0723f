"""The warehouse models as plain SQL, written independently of the Spark plans.

``CTES`` maps a name to its SELECT; names starting with ``raw_`` are the shared
raw tables. ``with_models`` prefixes a final SELECT with every CTE it needs.
"""

from __future__ import annotations

import re

from ledgerlens.plans.staging import HARVEST_USD_CAP, WRONG_HARVESTS
from ledgerlens.plans.stats import (
    BREAKDOWN,
    CHAIN_AVERAGES,
    CHAIN_SUMS,
    FEES,
    HARVEST_COLUMNS,
    LATEST_LABELS,
    LATEST_METRICS,
    LP_COLUMNS,
    METRICS,
    RATES,
    YIELD_COLUMNS,
)
from ledgerlens.workload.driver_tables import RAW_SQL, duckdb_sql

NATIVE = "'0x0000000000000000000000000000000000000000'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
SHIP_AS_OF = "DATE '2001-11-05'"


def network(c: str) -> str:
    return f"replace(lower(trim({c})), 'harmony', 'one')"


def repr_addr(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('native', 'null', '') THEN {NATIVE} ELSE lower({c}) END"


def str_list(c: str) -> str:
    return f"CAST(coalesce({c}, '[]')::JSON AS VARCHAR[])"


def repr_list(c: str) -> str:
    return f"[{repr_addr('x')} FOR x IN {c}]"


def hour(c: str) -> str:
    return f"CAST(date_trunc('hour', {c}) AS TIMESTAMP)"


def seconds(c: str) -> str:
    return f"TIMESTAMP '1970-01-01 00:00:00' + to_seconds({c})"


_DENY = ", ".join(f"({n}, '{h}')" for n, h in WRONG_HARVESTS)


def _between(cols: list[str], high: str) -> str:
    return " AND ".join(f"{c} BETWEEN 0 AND {high}" for c in cols)


def _last(cols: list[str], ts: str) -> str:
    return ", ".join(f"arg_max({c}, {ts}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


def _product_view(table: str, address: str, extra: str) -> str:
    return f"""
      SELECT d.chain_id, v.earn_contract_address AS {address}, v.id AS product_key,
        coalesce(v.oracle_id, v.id) AS price_oracle_key, v.name AS display_name, v.platform_id,
        coalesce(v.status = 'active', false) AS is_active, {seconds('v.created_at')} AS declared_creation_date,
        e.initialized_block AS creation_block, e.initialized_timestamp AS creation_datetime, {extra}
      FROM {table} v LEFT JOIN chain d ON v.network = d.chain_key"""


def _strategies(vaults: str, strategies: str, parent: str) -> str:
    return f"""
      SELECT v.network_id, v.address AS vault_address,
        '[' || string_agg('{{"address":"' || s.address || '","initialized_block":' ||
          try_cast(trim(s.initialized_block) AS BIGINT) || ',"initialized_timestamp":"' ||
          strftime(s.initialized_timestamp, '%Y-%m-%d %H:%M:%S') || '.000"}}', ',' ORDER BY s.address) || ']'
          AS strategies_json
      FROM {vaults} v JOIN {strategies} s ON v.id = s.{parent}
      WHERE s.address <> '' AND try_cast(trim(s.initialized_block) AS BIGINT) IS NOT NULL
        AND s.initialized_timestamp >= TIMESTAMP '2020-01-01'
      GROUP BY v.id, v.network_id, v.address"""


def _indexed(name: str) -> str:
    return f"""SELECT id, chainId AS network_id, lower(address) AS address,
      CAST(initializedBlock AS BIGINT) AS initialized_block, initializedTimestamp AS initialized_timestamp
      FROM raw_idx_{name}"""


def _strategy(name: str, raw_parent: str, parent: str) -> str:
    return f"""SELECT id, chainId AS network_id, lower(address) AS address, {raw_parent} AS {parent},
      CAST(initializedBlock AS VARCHAR) AS initialized_block, initializedTimestamp AS initialized_timestamp
      FROM raw_idx_{name}"""


ARRAYS = {
    "breakdown_tokens": "VARCHAR[]",
    "breakdown_balances": "DECIMAL(38,18)[]",
    "underlying_balances": "DECIMAL(38,18)[]",
}


def _pad(source: str, table: str, have: list[str]) -> str:
    cols = [c if c in have else f"CAST(NULL AS {ARRAYS.get(c, 'DOUBLE')}) AS {c}" for c in METRICS]
    return f"SELECT chain_id, product_address, date_hour, '{source}' AS source, {', '.join(cols)} FROM {table}"


_QUANT = ", ".join(f"quantile_cont({c}, [0.0, 0.25, 0.5, 0.75, 1.0]) AS {c}_quantiles" for c in CHAIN_AVERAGES)
_ACCOUNT_ROWS = f"""
  SELECT chain_id, product_address AS address, product_type AS label, true AS is_contract FROM product
  UNION ALL SELECT c.chain_id, s.address, 'clm_strategy', true FROM stg_clm_strategy s LEFT JOIN chain c USING (network_id)
  UNION ALL SELECT c.chain_id, s.address, 'classic_vault_strategy', true FROM stg_classic_vault_strategy s LEFT JOIN chain c USING (network_id)
  UNION ALL SELECT chain_id, erc20_address, 'erc20', true FROM token
  UNION ALL SELECT chain_id, a, 'underlying_token', true FROM (SELECT chain_id, unnest(underlying_token_representation_addresses) AS a FROM product_clm) WHERE a <> {NATIVE}
  UNION ALL SELECT chain_id, lp_token_representation_address, 'lp_token', true FROM product_clm WHERE lp_token_representation_address <> {NATIVE}
  UNION ALL SELECT chain_id, underlying_token_representation_address, 'smart_contract', true FROM product_classic WHERE underlying_token_representation_address <> {NATIVE}
  UNION ALL SELECT chain_id, underlying_token_representation_address, 'underlying_token', true FROM product_classic_boost WHERE underlying_token_representation_address <> {NATIVE}
  UNION ALL SELECT chain_id, reward_token_representation_address, 'reward_token', true FROM product_classic_boost WHERE reward_token_representation_address <> {NATIVE}
  UNION ALL SELECT chain_id, a, 'reward_token', true FROM (SELECT chain_id, unnest(reward_token_representation_addresses) AS a FROM product_reward_pool) WHERE a <> {NATIVE}
  UNION ALL SELECT c.chain_id, lower(m.address), nullif(m.label, ''), m.is_contract FROM raw_db_address_metadata m LEFT JOIN chain c ON m.chain_id = c.network_id WHERE m.is_contract OR nullif(m.label, '') IS NOT NULL
  UNION ALL SELECT chain_id, {NATIVE}, 'zero_address', false FROM chain
  UNION ALL SELECT chain_id, '0x000000000000000000000000000000000000dead', 'dead_address', false FROM chain
  UNION ALL SELECT t.chain_id, a.address, NULL, false FROM stg_balance_change t JOIN stg_account a ON t.account_id = a.id
  UNION ALL SELECT network_id, caller_address, NULL, false FROM stg_zap_records
  UNION ALL SELECT network_id, recipient_address, NULL, false FROM stg_zap_records
  UNION ALL SELECT network_id, from_address, NULL, false FROM stg_zap_parents
  UNION ALL SELECT network_id, to_address, 'smart_contract', true FROM stg_zap_parents
  UNION ALL SELECT network_id, token_address, 'erc20', true FROM stg_zap_transfers WHERE token_address <> {NATIVE}"""


def _legs(kind: str, name: str) -> str:
    order = "e, a, s, t, u"
    where = f"FILTER (WHERE zap_type = '{kind}')"
    return ", ".join(
        f"coalesce(list({col} ORDER BY {order}) {where}, []) AS {name}_{suffix}"
        for col, suffix in (
            ("a", "token_addresses"),
            ("s", "token_symbols"),
            ("t", "token_amounts"),
            ("u", "usd_values"),
        )
    ) + f", sum(u) {where} AS {name}_usd"


_LEG_KINDS = {"input": "input", "output": "output", "zap_fee": "protocol_fee", "refund": "refund"}
_LEG_COLUMNS = [f"{n}_{s}" for n in _LEG_KINDS for s in ("token_addresses", "token_symbols", "token_amounts", "usd_values")]

#: Tables that are loaded again, with their keys and their other columns.
_LOADED_AGAIN = {
    "db_apys": ("vault_id, t", "val"),
    "db_tvls": ("vault_id, t", "val"),
    "db_prices": ("oracle_id, t", "val"),
    "db_tvl_by_chain": ("chain_id, t", "total, vault, gov, clm"),
    "db_harvests": (
        "chain_id, block_number, txn_idx, event_idx, txn_timestamp",
        "txn_hash, vault_id, call_fee, gas_fee, platform_fee, strategist_fee, harvest_amount, native_price, want_price, "
        "is_keeper_call, strategist_address",
    ),
}


def _last_load(name: str) -> str:
    keys, others = _LOADED_AGAIN[name]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["_load_seq", *others.split(", ")])
    return f"SELECT * FROM ({duckdb_sql(name)}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


CTES: dict[str, str] = {
    **{f"raw_{name}": _last_load(name) if name in _LOADED_AGAIN else duckdb_sql(name) for name in RAW_SQL},
    "stg_ui_chains": f"""SELECT chain_id AS network_id, coalesce(name, 'Unknown') AS name, {network('chain_key')} AS chain_key,
      {str_list('rpc')} AS rpc, explorer_url, lower(multicall3_address) AS multicall3_address,
      lower(app_multicall_contract_address) AS ui_lens_address, native->>'$.symbol' AS native_symbol,
      gas->>'$.type' AS gas_type, {seconds('eol')} AS eol_date_time, disabled AS ui_disabled FROM raw_files_ui_chains""",
    "chain": """SELECT ui.network_id AS chain_id, ui.network_id, ui.name AS chain_name, ui.chain_key,
      CASE WHEN ui.eol_date_time IS NULL THEN true WHEN db.enabled IS NOT NULL THEN db.enabled <> 0
        WHEN ui.ui_disabled IS NOT NULL THEN NOT ui.ui_disabled ELSE false END AS is_enabled,
      ui.rpc AS public_rpc_urls, ui.explorer_url, ui.multicall3_address, ui.ui_lens_address, ui.gas_type, ui.eol_date_time
      FROM stg_ui_chains ui LEFT JOIN raw_db_chains db ON ui.network_id = db.chain_id""",
    "platform": f"""SELECT id AS platform_id, coalesce(name, 'Unknown') AS platform_name, website, type AS platform_type,
      {str_list('risks')} AS risks FROM raw_files_platforms""",
    "token": f"""SELECT chain_id, representation_address, erc20_address, is_native, symbol, name, decimals FROM (
      SELECT d.chain_id, {repr_addr('t.address')} AS representation_address,
        CASE WHEN t.type = 'erc20' THEN lower(t.address) END AS erc20_address, t.type = 'native' AS is_native,
        coalesce(t.symbol, 'Unknown') AS symbol, coalesce(t.name, 'Unknown') AS name, t.decimals,
        row_number() OVER (PARTITION BY d.chain_id, {repr_addr('t.address')} ORDER BY t.id) AS n
      FROM raw_api_tokens t JOIN chain d ON {network('t.chain_id')} = d.chain_key WHERE t.chain_id IS NOT NULL) WHERE n = 1""",
    "stg_vaults": f"""SELECT id, coalesce(name, 'Unknown') AS name, oracle_id, status, created_at, platform_id,
      {network('network')} AS network, is_gov_vault, lower(strategy) AS strategy, lower(token_address) AS token_address,
      lower(earn_contract_address) AS earn_contract_address FROM raw_api_vaults""",
    "clm_loads": """SELECT t.chain, lower(t.earned_token_address) AS tok, arg_max(l.load_id, l.inserted_at) AS load_id
      FROM raw_api_clm_vaults t JOIN raw_api_loads l ON t._load_id = l.load_id GROUP BY ALL""",
    "stg_clm_vaults": f"""SELECT t.id, coalesce(t.name, 'Unknown') AS name, t.oracle_id, t.status, t.created_at, t.platform_id,
      {network('t.network')} AS network, t.is_gov_vault, lower(t.strategy) AS strategy, lower(t.token_address) AS token_address,
      {str_list('t.deposit_token_addresses')} AS deposits, lower(t.earn_contract_address) AS earn_contract_address
      FROM raw_api_clm_vaults t JOIN clm_loads l ON t.chain = l.chain AND lower(t.earned_token_address) = l.tok AND t._load_id = l.load_id""",
    "gov_loads": f"""SELECT {network('t.chain')} AS chain, lower(t.earn_contract_address) AS addr, arg_max(l.load_id, l.inserted_at) AS load_id
      FROM raw_api_gov_vaults t JOIN raw_api_loads l ON t._load_id = l.load_id GROUP BY ALL""",
    "stg_gov_vaults": f"""SELECT t.id, coalesce(t.name, 'Unknown') AS name, t.oracle_id, t.status, t.created_at, t.platform_id, t.version,
      {network('t.network')} AS network, lower(t.token_address) AS token_address, {str_list('t.earned_token_addresses')} AS earned,
      lower(t.earn_contract_address) AS earn_contract_address FROM raw_api_gov_vaults t
      JOIN gov_loads l ON {network('t.chain')} = l.chain AND lower(t.earn_contract_address) = l.addr AND t._load_id = l.load_id""",
    "stg_classic_vault": _indexed("classic_vault"),
    "stg_clm_manager": _indexed("clm_manager"),
    "stg_reward_pool": _indexed("reward_pool"),
    "stg_classic_boost": _indexed("classic_boost"),
    "stg_classic_vault_strategy": _strategy("classic_vault_strategy", "classicVault_id", "classic_vault_id"),
    "stg_clm_strategy": _strategy("clm_strategy", "clmManager_id", "clm_manager_id"),
    "classic_strategies": _strategies("stg_classic_vault", "stg_classic_vault_strategy", "classic_vault_id"),
    "clm_strategies": _strategies("stg_clm_manager", "stg_clm_strategy", "clm_manager_id"),
    "product_classic": _product_view(
        "stg_vaults",
        "vault_address",
        f"v.strategy AS latest_strategy_address, {repr_addr('v.token_address')} AS underlying_token_representation_address, "
        "coalesce(s.strategies_json, '[]') AS strategies_json",
    )
    + """ LEFT JOIN stg_classic_vault e ON d.chain_id = e.network_id AND v.earn_contract_address = e.address
      LEFT JOIN classic_strategies s ON d.chain_id = s.network_id AND v.earn_contract_address = s.vault_address
      WHERE NOT v.is_gov_vault""",
    "product_clm": _product_view(
        "stg_clm_vaults",
        "vault_address",
        "v.strategy AS latest_strategy_address, v.token_address AS lp_token_representation_address, "
        f"{repr_list('v.deposits')} AS underlying_token_representation_addresses, coalesce(s.strategies_json, '[]') AS strategies_json",
    )
    + """ LEFT JOIN stg_clm_manager e ON d.chain_id = e.network_id AND v.earn_contract_address = e.address
      LEFT JOIN clm_strategies s ON d.chain_id = s.network_id AND v.earn_contract_address = s.vault_address
      WHERE NOT v.is_gov_vault""",
    "product_reward_pool": _product_view(
        "stg_gov_vaults",
        "reward_pool_address",
        f"v.token_address AS underlying_product_address, {repr_list('v.earned')} AS reward_token_representation_addresses",
    )
    + """ LEFT JOIN stg_reward_pool e ON d.chain_id = e.network_id AND v.earn_contract_address = e.address WHERE v.version = 2""",
    "product_classic_boost": f"""SELECT d.chain_id, lower(b.earn_contract_address) AS boost_address, b.id AS product_key,
      coalesce(v.price_oracle_key, b.id) AS price_oracle_key, b.id AS display_name, coalesce(b.status = 'active', false) AS is_active,
      {repr_addr('b.token_address')} AS underlying_token_representation_address,
      {repr_addr('b.earned_token_address')} AS reward_token_representation_address,
      e.initialized_block AS creation_block, e.initialized_timestamp AS creation_datetime, CAST(NULL AS TIMESTAMP) AS declared_creation_date
      FROM raw_api_boosts b JOIN chain d ON b.chain = d.chain_key
      LEFT JOIN stg_classic_boost e ON d.chain_id = e.network_id AND lower(b.earn_contract_address) = e.address
      LEFT JOIN product_classic v ON d.chain_id = v.chain_id AND {repr_addr('b.token_address')} = v.vault_address
      WHERE b.version IS NULL OR b.version < 2""",
    "product": " UNION ALL ".join(
        f"SELECT chain_id, '{kind}' AS product_type, {address} AS product_address, product_key, price_oracle_key, display_name, "
        f"is_active, {platform} AS platform_id, creation_block, creation_datetime, declared_creation_date FROM {table}"
        for kind, address, platform, table in (
            ("classic_vault", "vault_address", "platform_id", "product_classic"),
            ("clm_manager", "vault_address", "platform_id", "product_clm"),
            ("reward_pool", "reward_pool_address", "platform_id", "product_reward_pool"),
            ("classic_boost", "boost_address", "NULL", "product_classic_boost"),
        )
    ),
    "clm_bundles": """SELECT m.chain_id, coalesce(c.vault_address, m.vault_address) AS bundle_root_product_address, 'clm_bundle' AS bundle_type,
      m.is_active, m.product_key, m.display_name, m.platform_id, m.creation_block, m.creation_datetime,
      list_slice(list_sort(list_distinct(list(p.reward_pool_address) FILTER (WHERE p.reward_pool_address IS NOT NULL))), 1, 10) AS reward_pool_addresses,
      list_slice(list_sort(list_distinct(list(b.boost_address) FILTER (WHERE b.boost_address IS NOT NULL))), 1, 10) AS classic_boost_addresses
      FROM product_clm m
      LEFT JOIN product_classic c ON c.chain_id = m.chain_id AND c.underlying_token_representation_address = m.vault_address
      LEFT JOIN product_reward_pool p ON p.chain_id = m.chain_id
        AND (p.underlying_product_address = m.vault_address OR p.underlying_product_address = c.vault_address)
      LEFT JOIN product_classic_boost b ON b.chain_id = m.chain_id AND b.underlying_token_representation_address = m.vault_address
      GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "product_bundle": """SELECT * FROM clm_bundles UNION ALL
      SELECT c.chain_id, c.vault_address, 'classic_bundle', c.is_active, c.product_key, c.display_name, c.platform_id, c.creation_block, c.creation_datetime,
      list_slice(list_sort(list_distinct(list(p.reward_pool_address) FILTER (WHERE p.reward_pool_address IS NOT NULL))), 1, 10),
      list_slice(list_sort(list_distinct(list(b.boost_address) FILTER (WHERE b.boost_address IS NOT NULL))), 1, 10)
      FROM product_classic c
      LEFT JOIN product_reward_pool p ON p.chain_id = c.chain_id AND p.underlying_product_address = c.vault_address
      LEFT JOIN product_classic_boost b ON b.chain_id = c.chain_id AND b.underlying_token_representation_address = c.vault_address
      WHERE NOT EXISTS (SELECT 1 FROM clm_bundles x WHERE x.chain_id = c.chain_id AND x.bundle_root_product_address = c.vault_address)
      GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
    "stg_balance_change": f"""SELECT id, chainId AS chain_id, account_id, token_id, lower(trxHash) AS trx_hash, logIndex AS log_index,
      blockNumber AS block_number, blockTimestamp AS block_timestamp, CAST(balanceBefore AS DECIMAL(18,2)) AS balance_before,
      CAST(balanceAfter AS DECIMAL(18,2)) AS balance_after, {repr_addr("split_part(token_id, '-', 2)")} AS token_contract_address
      FROM raw_idx_token_balance_change""",
    "stg_account": "SELECT id, lower(address) AS address FROM raw_idx_account",
    "stg_zap_records": f"""SELECT chain_id AS network_id, block_number, txn_idx, event_idx, lower(txn_hash) AS txn_hash,
      lower(caller_address) AS caller_address, lower(recipient_address) AS recipient_address, target_chain_id AS target_network_id,
      vault_id AS product_key, action, total_usd, lower(bridge_hash) AS bridge_hash, {str_list('swap_source')} AS swap_source FROM raw_db_zap_records""",
    "stg_zap_parents": """SELECT chain_id AS network_id, block_number, txn_idx, txn_timestamp, lower(txn_hash) AS txn_hash, success, gas_used,
      native_price, lower(from_address) AS from_address, lower(to_address) AS to_address FROM raw_db_zap_parent_transactions""",
    "stg_zap_transfers": """SELECT chain_id AS network_id, block_number, txn_idx, parent_event_idx, event_idx, zap_type, token_id,
      token_amount, usd_value, lower(token_address) AS token_address FROM raw_db_zap_token_transfers""",
    "address_activity": """SELECT a.address, min(nullif(t.block_timestamp, TIMESTAMP '1970-01-01')) AS first_activity_timestamp,
      max(nullif(t.block_timestamp, TIMESTAMP '1970-01-01')) AS last_activity_timestamp, count(*) AS total_balance_changes,
      count(DISTINCT t.trx_hash) AS unique_transactions, count(DISTINCT t.token_id) AS unique_tokens
      FROM stg_balance_change t JOIN stg_account a ON t.account_id = a.id GROUP BY a.address""",
    "account": f"""SELECT m.address, m.labels, m.is_contract, m.active_chain_ids, act.first_activity_timestamp, act.last_activity_timestamp,
      coalesce(act.total_balance_changes, 0) AS total_balance_changes, coalesce(act.unique_transactions, 0) AS unique_transactions,
      coalesce(act.unique_tokens, 0) AS unique_tokens FROM (
        SELECT address, list_sort(list_distinct(coalesce(list(label) FILTER (WHERE label IS NOT NULL), []))) AS labels, bool_or(is_contract) AS is_contract,
          list_sort(list_distinct(list(CAST(chain_id AS BIGINT)) FILTER (WHERE chain_id IS NOT NULL))) AS active_chain_ids
        FROM ({_ACCOUNT_ROWS}) WHERE address IS NOT NULL AND address <> '' GROUP BY address) m
      LEFT JOIN address_activity act ON m.address = act.address""",
    "stg_prices": "SELECT CAST(oracle_id AS VARCHAR) AS oracle_id, t, max(val) AS val FROM raw_db_prices GROUP BY 1, 2",
    "int_price": """SELECT o.oracle_id AS oracle_key, p.t AS date_time, p.val AS price FROM stg_prices p
      JOIN raw_db_price_oracles o ON p.oracle_id = CAST(o.id AS VARCHAR) WHERE o.oracle_id NOT LIKE '%-rp'""",
    "int_product_price": """SELECT q.chain_id, q.product_address AS token_address, p.t AS date_time, p.val AS price FROM stg_prices p
      JOIN raw_db_price_oracles o ON p.oracle_id = CAST(o.id AS VARCHAR) JOIN product q ON o.oracle_id = q.price_oracle_key""",
    "int_tvl": """SELECT p.chain_id, p.product_address, t.date_time, t.tvl FROM raw_api_tvl t
      JOIN product p ON CAST(t.network_id AS BIGINT) = p.chain_id AND t.vault_id = p.product_key""",
    "stg_harvests": f"""SELECT * FROM (SELECT chain_id AS network_id, block_number, txn_idx, event_idx, txn_timestamp, lower(txn_hash) AS txn_hash,
        vault_id AS product_key, coalesce(call_fee, 0) AS call_fee, CAST(coalesce(gas_fee, 0) AS DECIMAL(19,0)) * CAST(0.000000000000000001 AS DECIMAL(18,18)) AS gas_fee,
        coalesce(platform_fee, 0) AS platform_fee, coalesce(strategist_fee, 0) AS strategist_fee, coalesce(harvest_amount, 0) AS harvest_amount,
        coalesce(native_price, 0) AS native_price, coalesce(want_price, 0) AS want_price, coalesce(is_keeper_call, false) AS is_keeper_call FROM raw_db_harvests)
      WHERE txn_timestamp IS NOT NULL AND harvest_amount > 0 AND want_price > 0 AND harvest_amount * want_price < {HARVEST_USD_CAP}
        AND (network_id, txn_hash) NOT IN ({_DENY})""",
    "product_harvests": """SELECT h.*, p.chain_id, p.product_address, p.product_type, p.display_name FROM stg_harvests h
      JOIN product p ON h.network_id = p.chain_id AND h.product_key = p.product_key""",
    "harvests": """SELECT txn_timestamp, chain_id, product_address, product_key, product_type, display_name, block_number, txn_idx, event_idx, txn_hash,
      call_fee AS harvest_call_fee, call_fee * native_price AS harvest_call_fee_usd, gas_fee,
      CAST(gas_fee AS DECIMAL(28,18)) * CAST(native_price AS DECIMAL(10,0)) AS gas_fee_usd, platform_fee, platform_fee * native_price AS platform_fee_usd,
      strategist_fee, strategist_fee * native_price AS strategist_fee_usd, harvest_amount, harvest_amount * want_price AS harvest_amount_usd,
      native_price AS avg_native_price FROM product_harvests""",
    "int_yield": """SELECT txn_timestamp, chain_id, product_address, block_number, txn_idx, event_idx, txn_hash,
      harvest_amount AS underlying_amount_compounded, want_price AS underlying_token_price_usd,
      harvest_amount * want_price AS underlying_amount_compounded_usd FROM product_harvests WHERE CAST(txn_timestamp AS DATE) > DATE '1970-01-01'""",
    "yield_harvest_events": "SELECT y.*, c.chain_name FROM int_yield y JOIN chain c USING (chain_id)",
    "tvl_hourly": f"""SELECT p.chain_id, p.product_address, {hour('a.t')} AS date_hour, arg_max(a.val, a.t) AS tvl_usd FROM raw_db_tvls a
      JOIN raw_db_vault_ids v ON a.vault_id = v.id JOIN product p ON v.vault_id = p.product_key
      WHERE a.val BETWEEN 0 AND 1000000000 GROUP BY 1, 2, 3""",
    "apy_hourly": f"""SELECT p.chain_id, p.product_address, {hour('a.t')} AS date_hour, arg_max(a.val, a.t) AS apy FROM raw_db_apys a
      JOIN raw_db_vault_ids v ON a.vault_id = v.id JOIN product p ON v.vault_id = p.product_key
      WHERE a.val BETWEEN 0 AND 1000000 GROUP BY 1, 2, 3""",
    "stg_apy_breakdown": "SELECT vault_id, date_time, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in BREAKDOWN)
    + " FROM raw_api_apy_breakdown",
    "apy_breakdown_hourly": f"""SELECT p.chain_id, p.product_address, {hour('a.date_time')} AS date_hour, {_last(BREAKDOWN, 'a.date_time')}
      FROM stg_apy_breakdown a JOIN product p ON a.vault_id = p.product_key
      WHERE {_between(FEES, '1000000000')} AND {_between(RATES, '1000000')} GROUP BY 1, 2, 3""",
    "stg_lps_breakdown": f"""SELECT vault_id, date_time, CAST(price AS DOUBLE) AS lp_price, {repr_list(str_list('tokens'))} AS breakdown_tokens,
      [CAST(x AS DECIMAL(38,18)) FOR x IN {str_list('balances')}] AS breakdown_balances, CAST(total_supply AS DOUBLE) AS total_supply,
      CAST(underlying_liquidity AS DOUBLE) AS underlying_liquidity, [CAST(x AS DECIMAL(38,18)) FOR x IN {str_list('underlying_balances')}] AS underlying_balances,
      CAST(underlying_price AS DOUBLE) AS underlying_price FROM raw_api_lps_breakdown""",
    "lps_breakdown_hourly": f"""SELECT p.chain_id, p.product_address, {hour('a.date_time')} AS date_hour, {_last(LP_COLUMNS, 'a.date_time')}
      FROM stg_lps_breakdown a JOIN product p ON a.vault_id = p.product_key
      WHERE lp_price BETWEEN 0 AND 1000000 AND total_supply BETWEEN 0 AND 1000000000000 AND underlying_liquidity BETWEEN 0 AND 1000000000000
        AND underlying_price BETWEEN 0 AND 1000000 GROUP BY 1, 2, 3""",
    "yield_hourly": f"""SELECT chain_id, product_address, {hour('txn_timestamp')} AS date_hour, """
    + ", ".join(f"arg_max({c}, (txn_timestamp, block_number, txn_idx, event_idx, {c})) AS {c}" for c in YIELD_COLUMNS)
    + """ FROM int_yield WHERE underlying_amount_compounded BETWEEN 0 AND 1000000000000 AND underlying_token_price_usd BETWEEN 0 AND 1000000
      AND underlying_amount_compounded_usd BETWEEN 0 AND 1000000000000 GROUP BY 1, 2, 3""",
    "harvest_hourly": f"""SELECT chain_id, product_address, {hour('txn_timestamp')} AS date_hour, sum(harvest_call_fee) AS harvest_call_fee,
      sum(harvest_call_fee_usd) AS harvest_call_fee_usd, sum(gas_fee) AS gas_fee, sum(gas_fee_usd) AS gas_fee_usd, sum(platform_fee) AS platform_fee,
      sum(platform_fee_usd) AS platform_fee_usd, sum(strategist_fee) AS strategist_fee, sum(strategist_fee_usd) AS strategist_fee_usd,
      sum(harvest_amount) AS harvest_amount, sum(harvest_amount_usd) AS harvest_amount_usd, avg(CAST(avg_native_price AS DOUBLE)) AS avg_native_price,
      count(DISTINCT txn_hash) AS harvest_txn_count, CAST(1 AS BIGINT) AS harvest_vault_count FROM harvests GROUP BY 1, 2, 3""",
    "unified_hourly": " UNION ALL ".join(
        [
            _pad("tvl", "tvl_hourly", ["tvl_usd"]),
            _pad("apy", "apy_hourly", ["apy"]),
            _pad("apy_breakdown", "apy_breakdown_hourly", BREAKDOWN),
            _pad("lps_breakdown", "lps_breakdown_hourly", LP_COLUMNS),
            _pad("yield", "yield_hourly", YIELD_COLUMNS),
            _pad("harvest", "harvest_hourly", HARVEST_COLUMNS),
        ]
    ),
    "folded_hourly": "SELECT chain_id, product_address, date_hour, "
    + ", ".join(
        f"coalesce(max({c}), []) AS {c}" if c in ARRAYS else f"max({c}) AS {c}" for c in METRICS
    )
    + " FROM unified_hourly GROUP BY 1, 2, 3",
    "product_stats": "SELECT f.chain_id, c.chain_name, p.product_type, p.product_key, f.product_address, p.display_name, p.is_active, p.platform_id, f.date_hour, "
    + ", ".join(f"f.{c}" for c in METRICS)
    + " FROM folded_hourly f JOIN chain c USING (chain_id) JOIN product p ON f.chain_id = p.chain_id AND f.product_address = p.product_address",
    "product_stats_latest": "SELECT chain_id, product_address, max(date_hour) AS date_hour, "
    + _last([*LATEST_LABELS, *LATEST_METRICS], "date_hour")
    + f" FROM product_stats AS s WHERE s.date_hour >= {AS_OF} - INTERVAL 15 DAY GROUP BY 1, 2",
    "chain_stats": "SELECT s.chain_id, c.chain_name, c.chain_key, c.is_enabled, s.date_hour, sum(s.tvl_usd) AS tvl_usd, "
    "sum(CASE WHEN s.product_type = 'classic_vault' THEN s.tvl_usd ELSE 0 END) AS vault_tvl_usd, "
    "sum(CASE WHEN s.product_type = 'clm_manager' THEN s.tvl_usd ELSE 0 END) AS clm_tvl_usd, "
    + ", ".join(f"avg(s.{c}) AS avg_{c}" for c in CHAIN_AVERAGES)
    + f", {_QUANT}, "
    + ", ".join(f"sum(s.{c}) AS {c}" for c in CHAIN_SUMS)
    + ", avg(s.avg_native_price) AS avg_native_price FROM product_stats s JOIN chain c ON s.chain_id = c.chain_id GROUP BY 1, 2, 3, 4, 5",
    "chain_stats_latest": "SELECT chain_id, max(date_hour) AS date_hour, "
    + _last(
        ["chain_name", "chain_key", "is_enabled", "tvl_usd", "vault_tvl_usd", "clm_tvl_usd"]
        + [f"avg_{c}" for c in CHAIN_AVERAGES]
        + [f"{c}_quantiles" for c in CHAIN_AVERAGES]
        + CHAIN_SUMS
        + ["avg_native_price"],
        "date_hour",
    )
    + f" FROM chain_stats AS s WHERE s.date_hour >= {AS_OF} - INTERVAL 15 DAY GROUP BY 1",
    "tvl_changes": "SELECT l.chain_id, l.product_address, l.product_type, l.product_key, l.display_name, l.is_active, l.platform_id, "
    "l.date_hour AS ref_hour, l.tvl_usd AS tvl_usd_current"
    + "".join(
        f", p{p}.tvl_usd AS tvl_usd_{p}_ago, l.tvl_usd - p{p}.tvl_usd AS tvl_usd_diff_{p}" for p in ("1d", "1w", "1m", "1y")
    )
    + " FROM product_stats_latest l"
    + "".join(
        f" LEFT JOIN product_stats p{p} ON l.chain_id = p{p}.chain_id AND l.product_address = p{p}.product_address "
        f"AND p{p}.date_hour = {AS_OF} - INTERVAL {n} DAY"
        for p, n in (("1d", 1), ("1w", 7), ("1m", 30), ("1y", 365))
    ),
    "product_tvl_diff": "SELECT *"
    + "".join(
        f", row_number() OVER (ORDER BY tvl_usd_diff_{p} DESC NULLS LAST, chain_id, product_address) AS rank_{p}_gainer"
        f", row_number() OVER (ORDER BY tvl_usd_diff_{p} ASC NULLS LAST, "
        f"CASE WHEN tvl_usd_diff_{p} IS NULL THEN chain_id ELSE -chain_id END, "
        f"CASE WHEN tvl_usd_diff_{p} IS NULL THEN product_address END ASC, product_address DESC) AS rank_{p}_loser"
        for p in ("1d", "1w", "1m", "1y")
    )
    + " FROM tvl_changes",
    "stg_token_buyback": """SELECT CAST(id AS VARCHAR) AS id, block_number, txn_timestamp, event_idx, lower(txn_hash) AS txn_hash,
      token_amount, token_price, buyback_total FROM raw_db_token_buyback
      WHERE buyback_total IS NOT NULL AND token_amount > 0 AND token_price > 0 AND CAST(txn_timestamp AS DATE) > DATE '1970-01-01'""",
    "revenue_buyback_events": """SELECT b.id, b.txn_timestamp, b.block_number, b.event_idx, b.txn_hash, t.chain_id,
      t.representation_address AS token_representation_address, t.erc20_address AS token_erc20_address, t.is_native AS token_is_native,
      t.symbol AS token_symbol, t.name AS token_name, t.decimals AS token_decimals, b.token_price AS token_price_usd,
      b.token_amount AS buyback_amount, b.token_amount * b.token_price AS buyback_usd FROM stg_token_buyback b JOIN token t ON t.symbol = 'TKN'""",
    "daily_revenue_summary": """SELECT date_day, coalesce(sum(y), 0) AS yield_usd, coalesce(sum(r), 0) AS revenue_usd, coalesce(sum(b), 0) AS buyback_usd FROM (
      SELECT CAST(txn_timestamp AS DATE) AS date_day, underlying_amount_compounded_usd AS y, NULL AS r, NULL AS b FROM int_yield
      UNION ALL SELECT CAST(txn_timestamp AS DATE), NULL, treasury_amt, NULL FROM raw_db_feebatch_harvests WHERE treasury_amt > 0
      UNION ALL SELECT CAST(txn_timestamp AS DATE), NULL, NULL, token_amount * token_price FROM stg_token_buyback) GROUP BY date_day""",
    "monthly_revenue": """SELECT date_trunc('month', date_day) AS month, sum(yield_usd) AS yield_usd, sum(revenue_usd) AS revenue_usd,
      sum(buyback_usd) AS buyback_usd FROM daily_revenue_summary GROUP BY 1""",
    "api_revenue_summary": f"""SELECT sum(revenue_usd) FILTER (WHERE date_day >= {SHIP_AS_OF} - 30) AS revenue_usd_30d,
      sum(yield_usd) FILTER (WHERE date_day >= {SHIP_AS_OF} - 7) AS yield_usd_7d,
      sum(buyback_usd) FILTER (WHERE date_day >= {SHIP_AS_OF} - 7) AS buyback_usd_7d
      FROM daily_revenue_summary WHERE date_day >= {SHIP_AS_OF} - 30""",
    "zap_base": """SELECT r.network_id, r.block_number, r.txn_idx, r.event_idx, p.txn_timestamp, coalesce(r.txn_hash, p.txn_hash) AS txn_hash,
      r.caller_address, r.recipient_address, r.target_network_id, r.product_key, r.action, r.total_usd, r.bridge_hash, r.swap_source,
      p.success, p.gas_used, p.native_price, p.from_address, p.to_address FROM stg_zap_records r
      JOIN stg_zap_parents p USING (network_id, block_number, txn_idx) WHERE r.product_key IS NOT NULL""",
    "zap_actions": """SELECT network_id, txn_hash, action FROM (SELECT network_id, txn_hash, action,
      row_number() OVER (PARTITION BY network_id, txn_hash ORDER BY count(*) DESC, action) AS n FROM zap_base GROUP BY 1, 2, 3) WHERE n = 1""",
    "zap_context": """SELECT network_id AS src_chain_id, txn_hash AS src_txn_hash, min(block_number) AS src_block_number, min(txn_idx) AS src_txn_idx,
      arg_min(txn_timestamp, event_idx) AS src_txn_timestamp, arg_min(caller_address, event_idx) AS caller_address,
      arg_min(recipient_address, event_idx) AS recipient_address, first(target_network_id ORDER BY event_idx) AS target_network_id,
      arg_min(product_key, event_idx) AS product_key, list_sort(list_distinct(list(action))) AS actions, sum(total_usd) AS total_usd,
      sum(CASE WHEN lower(action) = 'deposit' THEN total_usd WHEN lower(action) = 'withdrawal' THEN -total_usd ELSE 0 END) AS signed_usd,
      arg_min(bridge_hash, event_idx) AS bridge_hash, arg_min(swap_source, event_idx) AS swap_source, arg_min(success, event_idx) AS success,
      arg_min(gas_used, event_idx) AS gas_used, arg_min(native_price, event_idx) AS native_price, arg_min(from_address, event_idx) AS from_address,
      arg_min(to_address, event_idx) AS to_address, count(DISTINCT event_idx) AS event_count FROM zap_base GROUP BY 1, 2""",
    "zap_legs": "SELECT src_chain_id, src_txn_hash, "
    + ", ".join(_legs(kind, name) for name, kind in _LEG_KINDS.items())
    + """ FROM (SELECT b.network_id AS src_chain_id, b.txn_hash AS src_txn_hash, t.zap_type, t.token_address AS a, coalesce(o.oracle_id, '') AS s,
        t.token_amount AS t, t.usd_value AS u, t.event_idx AS e FROM zap_base b
      JOIN stg_zap_transfers t ON b.network_id = t.network_id AND b.block_number = t.block_number AND b.txn_idx = t.txn_idx AND b.event_idx = t.parent_event_idx
      LEFT JOIN raw_db_price_oracles o ON t.token_id = o.id WHERE t.zap_type IS NOT NULL) GROUP BY 1, 2""",
    "zap_activity": """SELECT c.src_chain_id, s.chain_name AS src_chain_name, s.chain_key AS src_chain_key, s.is_enabled AS src_chain_is_enabled, c.src_txn_hash,
      c.src_block_number, c.src_txn_idx, c.src_txn_timestamp, CAST(c.src_txn_timestamp AS DATE) AS src_txn_date,
      coalesce(c.target_network_id, c.src_chain_id) AS dst_chain_id, d.chain_name AS dst_chain_name, d.chain_key AS dst_chain_key,
      d.is_enabled AS dst_chain_is_enabled, coalesce(c.target_network_id, c.src_chain_id) = c.src_chain_id AS is_same_chain_zap,
      c.caller_address, coalesce(x.labels, []) AS caller_labels, coalesce(x.is_contract, false) AS caller_is_contract, c.recipient_address,
      coalesce(y.labels, []) AS recipient_labels, coalesce(y.is_contract, false) AS recipient_is_contract, c.product_key, a.action, c.actions,
      CASE lower(a.action) WHEN 'deposit' THEN 'inflow' WHEN 'withdrawal' THEN 'outflow' ELSE 'other' END AS flow_direction,
      c.total_usd, c.signed_usd, """
    + ", ".join(f"coalesce(l.{n}_usd, 0) AS {n}_usd" for n in _LEG_KINDS)
    + ", "
    + ", ".join(f"coalesce(l.{c}, []) AS {c}" for c in _LEG_COLUMNS)
    + """, c.success, c.gas_used, c.native_price, c.from_address, c.to_address, c.bridge_hash, c.swap_source, c.event_count
      FROM zap_context c JOIN zap_actions a ON c.src_chain_id = a.network_id AND c.src_txn_hash = a.txn_hash
      LEFT JOIN zap_legs l USING (src_chain_id, src_txn_hash) LEFT JOIN chain s ON c.src_chain_id = s.chain_id
      LEFT JOIN chain d ON coalesce(c.target_network_id, c.src_chain_id) = d.chain_id
      LEFT JOIN account x ON c.caller_address = x.address LEFT JOIN account y ON c.recipient_address = y.address""",
    "indexed_chains": """SELECT DISTINCT b.chainId AS network_id, c.chain_id FROM raw_idx_token_balance b
      JOIN stg_account a ON b.account_id = a.id JOIN chain c ON b.chainId = c.network_id""",
    "missing_products_in_index": " UNION ALL ".join(
        f"""SELECT p.chain_id, c.chain_name, p.{address} AS product_address, p.product_key, p.display_name, p.is_active, p.declared_creation_date,
          '{index}' AS missing_in_model FROM {table} p JOIN indexed_chains i ON p.chain_id = i.chain_id JOIN chain c ON p.chain_id = c.chain_id
          WHERE (p.chain_id, p.{address}) NOT IN (SELECT network_id, address FROM {index.replace('idx_', 'stg_')})"""
        for table, address, index in (
            ("product_classic", "vault_address", "idx_classic_vault"),
            ("product_clm", "vault_address", "idx_clm_manager"),
            ("product_reward_pool", "reward_pool_address", "idx_reward_pool"),
            ("product_classic_boost", "boost_address", "idx_classic_boost"),
        )
    ),
}


def _timeline(low: str, high: str | None, version: bool = False) -> str:
    def upper(c: str) -> str:
        return f" AND {c} < {high}" if high else ""

    return f"""SELECT t.block_timestamp AS datetime, t.account_id, p.product_key, p.display_name AS product_display_name, t.chain_id, c.chain_name,
      p.product_type, t.token_contract_address AS product_address, NOT p.is_active AS is_eol, t.block_number, t.trx_hash AS transaction_hash, t.log_index,
      q.price AS share_to_usd_price, t.balance_after AS share_balance_after, t.balance_before AS share_balance_before,
      t.balance_after - t.balance_before AS share_balance_diff, t.balance_before * coalesce(q.price, 0) AS usd_balance_before,
      t.balance_after * coalesce(q.price, 0) AS usd_balance_after, (t.balance_after - t.balance_before) * coalesce(q.price, 0) AS usd_balance_diff
      FROM stg_balance_change t JOIN product p ON t.chain_id = p.chain_id AND t.token_contract_address = p.product_address
      JOIN chain c ON t.chain_id = c.chain_id
      ASOF LEFT JOIN (SELECT * FROM int_product_price WHERE date_time >= {low}{upper('date_time')}) q
        ON t.chain_id = q.chain_id AND t.token_contract_address = q.token_address AND t.block_timestamp >= q.date_time
      WHERE t.block_timestamp >= {low}{upper('t.block_timestamp')}"""


CTES["investor_timeline_recent"] = _timeline(f"{AS_OF} - INTERVAL 15 DAY", None)
CTES["investor_timeline_historical"] = _timeline("TIMESTAMP '2023-12-31'", f"{AS_OF} - INTERVAL 7 DAY")
CTES["investor_timeline"] = (
    f"SELECT * FROM investor_timeline_historical WHERE datetime < {AS_OF} - INTERVAL 11 DAY "
    f"UNION ALL SELECT * FROM investor_timeline_recent WHERE datetime >= {AS_OF} - INTERVAL 11 DAY"
)


def _needed(sql: str, seen: dict[str, None], open_names: frozenset[str] = frozenset()) -> None:
    for name in re.findall(r"\b[a-z][a-z0-9_]*\b", sql):
        if name in CTES and name not in seen and name not in open_names:
            _needed(CTES[name], seen, open_names | {name})
            seen[name] = None


def with_models(final: str) -> str:
    """``final`` with the CTEs it refers to, dependencies first."""
    seen: dict[str, None] = {}
    _needed(final, seen)
    if not seen:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in seen) + "\n" + final
