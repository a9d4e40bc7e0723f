"""Raw warehouse tables derived from the driver tables.

Each entry is a SELECT in the SQL subset that Spark and DuckDB share, so both
engines start from the same raw rows. ``{name}`` stands for a driver table.
Derivation is by row, so every raw table grows with its driver table:

* nations are chains, parts are products (ten consecutive parts form a family on
  one chain: six classic vaults, two CLM vaults, a reward pool and a boost);
* events are metric series and balance changes of the product ``user_id``;
* line items are harvests and token legs, orders are zaps, buybacks and fees;
* customers are accounts, suppliers are labelled addresses.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_utc, ensure_wide
from ledgerlens.sources.catalog import Warehouse

# One day past the newest event, and past the newest ship date.
EVENTS_AS_OF = datetime(2024, 1, 31)
SHIP_AS_OF = datetime(2001, 11, 5)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def text(expr: str) -> str:
    return f"cast({expr} as string)"


def address(letter: str, expr: str, size: int = 40) -> str:
    return f"('0x{letter}' || lpad({text(expr)}, {size - len(letter)}, '0'))"


def family(key: str) -> str:
    return f"cast(floor({key} / 10) as bigint)"


def chain_of(key: str) -> str:
    return f"({family(key)} % 25 + 1)"


PARTS = (
    f"(SELECT p_partkey AS k, {family('p_partkey')} AS b, p_partkey % 10 AS m, "
    f"{family('p_partkey')} % 25 AS c, p_name, p_brand, p_type, p_size, p_retailprice FROM {{part}}) p"
)
NETWORK = f"case when c = 7 then ' Harmony' else 'Nation_' || {text('c')} end"
CHAIN_KEY = f"case when c = 7 then 'one' else 'nation_' || {text('c')} end"
PRODUCT = address("A", "k")
COIN = address("B", "k % 400")
CREATED = "cast(1650000000 + k * 3600 as bigint)"
STATUS = "case when k % 3 = 0 then 'eol' else 'active' end"
ORACLE = f"case when k % 4 = 0 then null else 'oracle-' || {text('k')} end"
SEEN_AT = (
    f"cast('2021-' || lpad({text('k % 12 + 1')}, 2, '0') || '-' || lpad({text('k % 28 + 1')}, 2, '0')"
    " || ' 05:00:00' as timestamp)"
)
LISTING = (
    f"'vault-' || {text('k')} AS id, case when k % 11 = 0 then null else p_name end AS name, "
    f"{PRODUCT} AS earn_contract_address, {PRODUCT} AS earned_token_address, {ORACLE} AS oracle_id, "
    f"{STATUS} AS status, {CREATED} AS created_at, lower(p_brand) AS platform_id, {NETWORK} AS network, "
    f"{address('D', 'k')} AS strategy"
)
POOL_UNDERLYING = (
    f"case when b % 3 = 0 then {address('A', 'k - 8')} when b % 3 = 1 then {address('A', 'k - 2')} "
    f"else {address('A', 'k - 3')} end"
)
BOOST_UNDERLYING = (
    f"case when b % 2 = 0 then {address('A', 'k - 8')} else {address('A', 'k - 2')} end"
)
CLM_LISTING = (
    f"{NETWORK} AS chain, {address('E', 'k')} AS token_address, "
    f"'[\"' || {COIN} || '\",\"native\"]' AS deposit_token_addresses, false AS is_gov_vault"
)
GOV_LISTING = (
    f"{NETWORK} AS chain, {POOL_UNDERLYING} AS token_address, "
    f"'[\"' || {COIN} || '\",\"null\"]' AS earned_token_addresses, true AS is_gov_vault, "
    "case when b % 5 = 4 then 1 else 2 end AS version"
)


def _indexed(prefix: str, where: str) -> str:
    return (
        f"SELECT '{prefix}-' || {text('k')} AS id, c + 1 AS chainId, {PRODUCT} AS address, "
        f"'share-' || {text('k')} AS shareToken_id, 'under-' || {text('k')} AS underlyingToken_id, "
        f"'INITIALIZED' AS initializableStatus, k * 10 AS initializedBlock, {SEEN_AT} AS initializedTimestamp "
        f"FROM {PARTS} WHERE {where}"
    )


def _strategies(prefix: str, parent: str, where: str) -> str:
    def one(n: int, block: str, at: str, extra: str) -> str:
        return (
            f"SELECT '{prefix}s{n}-' || {text('k')} AS id, c + 1 AS chainId, "
            f"{address(f'D{n}', 'k')} AS address, '{prefix}-' || {text('k')} AS {parent}, "
            f"'INITIALIZED' AS initializableStatus, {block} AS initializedBlock, {at} AS initializedTimestamp "
            f"FROM {PARTS} WHERE {where}{extra}"
        )

    padded = f"case when k % 9 = 0 then ' ' else ' ' || {text('k * 10')} || ' ' end"
    early = "cast('2019-06-01 00:00:00' as timestamp)"
    return " UNION ALL ".join(
        [
            one(1, padded, SEEN_AT, ""),
            one(2, text("k * 10 + 5"), f"case when k % 8 = 0 then {early} else {SEEN_AT} end", " AND k % 2 = 0"),
        ]
    )


# A wrong-harvest hash from the deny list, in mixed case, on chain 1.
LISTED_HASH = "0xEC308AAA41bea030e06de958af46179803f96c3c78950b8da2c4912a1775d87a"
EVENT_PRODUCT = f"'vault-' || {text('user_id')}"
MONEY = "cast(value as decimal(18,2))"
SERIES = f"'e-' || {text('event_id')} AS etag, ts AS date_time, {EVENT_PRODUCT} AS vault_id"

_CALL = "o_custkey % 25 + 1 AS chain_id, o_orderkey AS block_number, o_orderkey % 3 AS txn_idx"
_ZAP_HASH = address("FA", "o_orderkey", 64)


def _zap(event_idx: int, action: str, usd: str, where: str) -> str:
    return (
        f"SELECT {_CALL}, {event_idx} AS event_idx, "
        f"case when o_orderkey % 6 = 0 then null else {_ZAP_HASH} end AS txn_hash, "
        f"{address('C', 'o_custkey')} AS caller_address, {address('C', '(o_custkey + 1) % 1000')} AS recipient_address, "
        "o_custkey % 25 + 1 AS source_chain_id, "
        "case when o_orderkey % 2 = 1 then null else o_custkey % 7 + 1 end AS target_chain_id, "
        f"case when o_orderkey % 10 = 0 then null else 'vault-' || {text('o_orderkey % 100')} end AS vault_id, "
        f"{action} AS action, {usd} AS total_usd, {address('FB', 'o_orderkey', 64)} AS bridge_hash, "
        "'[\"router\",\"pool\"]' AS swap_source, o_orderdate AS created_at, o_orderdate AS updated_at "
        f"FROM {{orders}} WHERE {where}"
    )


def _message(version: int, where: str) -> str:
    state = "'pending'" if version == 1 else "'done'"
    updated = "o_orderdate" if version == 1 else "o_orderdate + INTERVAL '2' DAY"
    return (
        f"SELECT ' ' || {text('o_custkey % 5 + 1')} || ' ' AS src_network_id, {_ZAP_HASH} AS src_tx_hash, "
        f"1 AS src_log_index, {updated} AS updated_at, o_orderdate AS created_at, "
        f"{text('o_orderkey')} AS src_block_number, {address('C', 'o_custkey')} AS src_sender, "
        f"case when o_orderkey % 7 = 0 then null else {text('o_orderkey * 1000 + 123')} end AS src_burn_amount, "
        f"{state} AS lifecycle_state, 'n/a' AS dst_network_id, "
        f"case when {version} = 2 then true else null end AS dst_zap_success, "
        f"{text('o_orderkey * 999')} AS dst_amount_in FROM {{orders}} WHERE {where}"
    )


_QUANTITY = (
    "case when l_orderkey % 97 = 0 then cast(l_quantity * 1000 as decimal(18,2)) "
    "when l_orderkey % 89 = 0 then null else cast(l_quantity as decimal(18,2)) end"
)


def _harvests(load: int, amount: str, where: str) -> str:
    return (
        f"SELECT {chain_of('l_partkey')} AS chain_id, l_orderkey AS block_number, l_linenumber AS txn_idx, "
        "l_suppkey AS event_idx, l_shipdate AS txn_timestamp, "
        f"case when l_orderkey % 7 = 3 then '{LISTED_HASH}' else {address('FC', 'l_orderkey', 64)} end AS txn_hash, "
        f"'vault-' || {text('l_partkey')} AS vault_id, cast(l_discount as decimal(18,2)) AS call_fee, "
        "cast(l_linenumber as bigint) * 1000000000000001 AS gas_fee, cast(l_tax as decimal(18,2)) AS platform_fee, "
        "case when l_linenumber = 3 then null else cast(l_discount as decimal(18,2)) end AS strategist_fee, "
        f"{amount} AS harvest_amount, cast(100 + l_linenumber as decimal(18,2)) AS native_price, "
        "cast(l_extendedprice as decimal(18,2)) AS want_price, "
        "case when l_linenumber = 1 then true else null end AS is_keeper_call, "
        f"{address('D', 'l_partkey')} AS strategist_address, {load} AS _load_seq FROM {{lineitem}} WHERE {where}"
    )


def _loads(columns: str, values: dict[int, tuple[str, str]]) -> str:
    """One SELECT over events per load: its number, its values, and the events it holds."""
    return " UNION ALL ".join(
        f"SELECT {columns}, {value}, {load} AS _load_seq FROM {{events}} WHERE {where}" for load, (value, where) in values.items()
    )


RAW_SQL: dict[str, str] = {
    "files_ui_chains": (
        "SELECT n_nationkey + 1 AS chain_id, n_name AS name, "
        "case when n_nationkey = 7 then ' HARMONY' else n_name end AS chain_key, "
        f"'[\"https://rpc.test/' || {text('n_nationkey')} || '\",\"wss://rpc.test\"]' AS rpc, "
        f"'https://scan.test/' || {text('n_nationkey')} AS explorer_url, "
        f"{address('AB', 'n_nationkey')} AS multicall3_address, "
        f"{address('AC', 'n_nationkey')} AS app_multicall_contract_address, "
        f"'{{{{\"symbol\":\"T' || {text('n_nationkey')} || '\",\"oracleId\":\"o' || {text('n_nationkey')} "
        "|| '\",\"decimals\":\"18\"}}' AS native, "
        "'{{\"type\":\"' || case when n_regionkey = 0 then 'eip1559' else 'standard' end || '\"}}' AS gas, "
        "case when n_nationkey % 5 = 0 then cast(1600000000 + n_nationkey * 86400 as bigint) end AS eol, "
        "n_nationkey % 3 = 0 AS disabled, n_nationkey % 2 = 0 AS new FROM {nation}"
    ),
    "files_platforms": (
        "SELECT lower(p_brand) AS id, min(p_brand) AS name, 'https://' || lower(p_brand) AS website, "
        "'[\"R1\",\"R2\"]' AS risks, min(p_type) AS type FROM {part} GROUP BY lower(p_brand)"
    ),
    "db_chains": (
        "SELECT n_nationkey + 1 AS chain_id, n_name AS name, "
        "case when n_nationkey % 4 = 0 then null else lower(n_name) end AS short_name, "
        "n_nationkey % 2 AS enabled FROM {nation} WHERE n_nationkey % 4 <> 1"
    ),
    "api_loads": (
        f"SELECT 'L' || {text('r_regionkey')} AS load_id, 'api' AS schema_name, 0 AS status, "
        f"cast('2024-01-0' || {text('r_regionkey + 1')} || ' 00:00:00' as timestamp) AS inserted_at, "
        "r_name AS schema_version_hash FROM {region}"
    ),
    "api_tokens": (
        f"SELECT case when k % 7 = 0 then 'native' else 'erc20' end AS type, 'tok-' || {text('k')} AS id, "
        "case when k % 101 = 0 and k < 300 then 'TKN' when k % 17 = 0 then null "
        f"else 'SYM' || {text('k')} end AS symbol, p_name AS name, {NETWORK} AS chain_id, "
        f"case when k % 7 = 0 then ' Native ' else {COIN} end AS address, 18 AS decimals FROM {PARTS}"
    ),
    "api_vaults": (
        f"SELECT {LISTING}, case when m = 0 then {address('A', 'k + 6')} else {COIN} end AS token_address, "
        f"m = 8 AS is_gov_vault FROM {PARTS} WHERE m < 6 OR m = 8"
    ),
    "api_clm_vaults": (
        f"SELECT {LISTING}, {CLM_LISTING}, 'L2' AS _load_id FROM {PARTS} WHERE m IN (6, 7) AND b % 2 = 0 "
        f"UNION ALL SELECT {LISTING.replace('vault-', 'old-', 1)}, {CLM_LISTING}, 'L1' AS _load_id "
        f"FROM {PARTS} WHERE m IN (6, 7) AND b % 2 = 0 "
        f"UNION ALL SELECT {LISTING}, {CLM_LISTING}, 'L1' AS _load_id FROM {PARTS} "
        "WHERE m IN (6, 7) AND b % 2 = 1"
    ),
    "api_gov_vaults": (
        f"SELECT {LISTING}, {GOV_LISTING}, 'L1' AS _load_id FROM {PARTS} WHERE m = 8 "
        f"UNION ALL SELECT {LISTING}, {GOV_LISTING}, 'L3' AS _load_id FROM {PARTS} WHERE m = 8 AND b % 2 = 1"
    ),
    "api_legacy_clm_vaults": (
        f"SELECT {LISTING}, {CLM_LISTING} FROM {PARTS} WHERE m = 7"
    ),
    "api_boosts": (
        f"SELECT 'vault-' || {text('k')} AS id, p_name AS name, {CHAIN_KEY} AS chain, "
        "case when b % 4 = 0 then null when b % 4 = 2 then 2 else 1 end AS version, "
        f"{STATUS} AS status, {PRODUCT} AS earn_contract_address, {BOOST_UNDERLYING} AS token_address, "
        f"{COIN} AS earned_token_address, true AS is_share_staked FROM {PARTS} WHERE m = 9"
    ),
    "api_apy": (
        f"SELECT {SERIES}, case when event_id % 9 = 0 then null else {text(MONEY)} end AS apy "
        "FROM {events} WHERE event_type = 'click'"
    ),
    "api_apy_breakdown": (
        f"SELECT {SERIES}, {text('event_id % 1000')} AS compoundings_per_year, '0.045' AS performance_fee, "
        f"{text(MONEY)} AS lp_fee, case when event_id % 17 = 0 then null else {text(MONEY)} end AS total_apy, "
        f"{text('event_id % 50')} AS vault_apr, {text('event_id % 60')} AS trading_apr, "
        f"{text('event_id % 70')} AS clm_apr, {text('event_id % 80')} AS reward_pool_apr, "
        f"{text('event_id % 90')} AS reward_pool_trading_apr, "
        f"{text('(event_id % 100) * 20000')} AS vault_apy, {text(MONEY)} AS liquid_staking_apr, "
        f"case when event_id % 2 = 0 then null else {text(MONEY)} end AS composable_pool_apr, "
        f"case when event_id % 3 = 0 then null else {text('event_id % 7')} end AS merkl_apr, "
        f"case when event_id % 5 = 0 then null else {text('event_id % 9')} end AS linea_ignition_apr "
        "FROM {events} WHERE event_type = 'signup'"
    ),
    "api_lps": f"SELECT {SERIES}, {text(MONEY)} AS lps FROM {{events}} WHERE event_type = 'error'",
    "api_lps_breakdown": (
        f"SELECT {SERIES}, {text(MONEY)} AS price, "
        f"'[\"' || {address('B', 'user_id % 400')} || '\",\"native\"]' AS tokens, "
        f"'[\"' || {text(MONEY)} || '\",\"2.5\"]' AS balances, {text('event_id * 1000')} AS total_supply, "
        f"{text(MONEY)} AS underlying_liquidity, "
        f"case when event_id % 4 = 0 then null else '[\"' || {text(MONEY)} || '\"]' end AS underlying_balances, "
        f"{text('event_id % 2000 * 1000')} AS underlying_price FROM {{events}} WHERE event_type = 'error'"
    ),
    "api_share_token_prices": (
        f"SELECT 'e-' || {text('event_id')} AS etag, ts AS date_time, {text(chain_of('user_id'))} AS chain_id, "
        f"case when event_id % 10 = 0 then null else 'share-' || {text('user_id')} end AS share_token_symbol, "
        f"case when event_id % 12 = 0 then null else {text(MONEY)} end AS price "
        "FROM {events} WHERE event_type = 'view'"
    ),
    "api_prices": (
        f"SELECT 'e-' || {text('event_id')} AS etag, ts AS date_time, 'T' || {text('user_id')} AS token_symbol, "
        f"{text(MONEY)} AS price FROM {{events}} WHERE event_type = 'purchase'"
    ),
    "api_tvl": (
        f"SELECT {SERIES}, {text(chain_of('user_id'))} AS network_id, value AS tvl "
        "FROM {events} WHERE event_type = 'view'"
    ),
    "api_treasury": (
        f"SELECT 'e-' || {text('event_id')} AS etag, ts AS date_time, {text(chain_of('user_id'))} AS chain_id, "
        f"{address('C', 'user_id')} AS wallet_address, 'ops' AS wallet_name, "
        f"case when event_id % 3 = 0 then 'native' else {address('B', 'event_id % 400')} end AS token_address, "
        f"'18' AS decimals, {text(MONEY)} AS balance, {text(MONEY)} AS usd_value, "
        "case when event_id % 2 = 0 then 'true' else null end AS staked FROM {events}"
    ),
    "api_treasury_mm": (
        f"SELECT 'e-' || {text('event_id')} AS etag, ts AS date_time, 'mm-' || {text('user_id % 5')} AS mm_id, "
        f"event_type AS exchange_name, 'T' || {text('user_id')} AS token_symbol, {text(MONEY)} AS balance, "
        f"{text(MONEY)} AS usd_value FROM {{events}}"
    ),
    "db_address_metadata": (
        f"SELECT s_nationkey + 1 AS chain_id, {address('C', 's_suppkey')} AS address, "
        "s_suppkey % 2 = 0 AS is_contract, case when s_suppkey % 3 = 0 then '' "
        "when s_suppkey % 3 = 1 then 'exchange' else null end AS label FROM {supplier}"
    ),
    # Windows loaded again hold lower values; one price load that comes last in the file is an older one.
    "db_apys": _loads(
        "user_id AS vault_id, ts AS t",
        {
            1: ("case when event_id % 40 = 0 then -1.0 else value / 100 end AS val", "event_type = 'click'"),
            2: ("floor(value) / 100 AS val", "event_type = 'click' AND event_id % 6 = 0"),
        },
    ),
    "db_tvls": _loads(
        "user_id AS vault_id, ts AS t",
        {
            1: ("case when event_id % 50 = 0 then value * 100000000 else value * 1000 end AS val", "event_type = 'view'"),
            2: ("value * 500 AS val", "event_type = 'view' AND event_id % 6 = 0"),
        },
    ),
    "db_vault_ids": f"SELECT k AS id, 'vault-' || {text('k')} AS vault_id FROM {PARTS}",
    "db_price_oracles": (
        f"SELECT k AS id, case when k % 13 = 0 then 'oracle-' || {text('k')} || '-rp' "
        f"when k % 4 = 0 then 'vault-' || {text('k')} else 'oracle-' || {text('k')} end AS oracle_id, "
        f"case when k % 2 = 0 then null else '[\"a\"]' end AS tokens FROM {PARTS}"
    ),
    "db_prices": _loads(
        "user_id AS oracle_id, ts AS t",
        {
            1: (f"{MONEY} AS val", "event_type = 'purchase'"),
            2: ("cast(floor(value) as decimal(18,2)) AS val", "event_type = 'purchase' AND event_id % 5 = 0"),
            0: (f"cast({MONEY} + 100 as decimal(18,2)) AS val", "event_type = 'purchase' AND event_id % 4 = 0"),
        },
    ),
    "db_tvl_by_chain": _loads(
        "user_id % 25 + 1 AS chain_id, ts AS t",
        {
            load: (f"{total} AS total, {total} AS vault, cast(0 as decimal(18,2)) AS gov, cast(0 as decimal(18,2)) AS clm", where)
            for load, total, where in ((1, MONEY, "event_id >= 0"), (2, "cast(floor(value) as decimal(18,2))", "event_id % 6 = 0"))
        },
    ),
    "db_vault_strategies": (
        f"SELECT k AS id, c + 1 AS chain_id, k * 10 AS block_number, {address('FE', 'k', 64)} AS txn_hash, "
        f"'vault-' || {text('k')} AS vault_id, {PRODUCT} AS vault_address, {address('D', 'k')} AS strategy_address "
        f"FROM {PARTS}"
    ),
    "db_harvests": _harvests(1, _QUANTITY, "l_orderkey >= 0")
    + " UNION ALL "
    + _harvests(2, "cast(floor(l_quantity / 2) as decimal(18,2))", "l_orderkey % 9 = 0"),
    "db_token_buyback": (
        "SELECT o_orderkey AS id, o_orderkey AS block_number, o_orderdate AS txn_timestamp, 0 AS event_idx, "
        f"{address('FD', 'o_orderkey', 64)} AS txn_hash, cast(o_custkey % 100 as decimal(18,2)) AS token_amount, "
        "cast(2.5 as decimal(18,2)) AS token_price, case when o_orderkey % 11 = 0 then null "
        "else cast(o_totalprice as decimal(18,2)) end AS buyback_total FROM {orders}"
    ),
    "db_feebatch_harvests": (
        f"SELECT {text('o_orderkey')} AS row_id, o_custkey % 25 + 1 AS chain_id, o_orderkey AS block_number, "
        f"o_orderdate AS txn_timestamp, {address('FE', 'o_orderkey', 64)} AS txn_hash, "
        "cast(o_totalprice as decimal(18,2)) AS harvest_usd, case when o_orderkey % 13 = 0 then null "
        "else cast(o_totalprice as decimal(18,2)) end AS treasury_amt FROM {orders}"
    ),
    "db_zap_parent_transactions": (
        f"SELECT {_CALL}, o_orderdate AS txn_timestamp, {_ZAP_HASH} AS txn_hash, "
        "cast(0 as decimal(18,2)) AS value, 5 AS effective_gas_price, 100 AS gas_limit, "
        "o_orderkey % 1000 AS gas_used, cast(o_custkey % 10 as decimal(18,2)) AS native_price, "
        f"{address('C', 'o_custkey')} AS from_address, {address('F', 'o_custkey % 3')} AS to_address, "
        "'0x' AS calldata, o_orderkey % 20 <> 0 AS success, o_orderdate AS created_at FROM {orders}"
    ),
    "db_zap_records": _zap(
        100,
        "case when o_orderkey % 3 = 0 then 'Deposit' when o_orderkey % 3 = 1 then 'withdrawal' else 'claim' end",
        "cast(o_totalprice as decimal(18,2))",
        "o_orderkey >= 0",
    )
    + " UNION ALL "
    + _zap(200, "'Deposit'", "cast(10 as decimal(18,2))", "o_orderkey % 3 = 1"),
    "db_zap_token_transfers": (
        f"SELECT {_CALL}, case when o_orderkey % 3 = 1 and l_linenumber % 2 = 0 then 200 else 100 end "
        "AS parent_event_idx, l_linenumber AS event_idx, case when l_suppkey % 20 = 0 then null "
        "when l_returnflag = 'A' then 'input' when l_returnflag = 'N' then 'output' "
        "when l_linenumber % 2 = 0 then 'protocol_fee' else 'refund' end AS zap_type, "
        "case when l_linenumber = 5 then null else l_partkey end AS token_id, "
        "cast(l_quantity as decimal(18,2)) AS token_amount, cast(l_extendedprice as decimal(18,2)) AS usd_value, "
        f"{address('B', 'l_partkey % 400')} AS token_address, l_shipdate AS created_at, l_shipdate AS updated_at "
        "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
    ),
    "bridge_messages": _message(1, "o_orderkey >= 0") + " UNION ALL " + _message(2, "o_orderkey % 4 = 0"),
    "idx_account": (
        f"SELECT 'acc-' || {text('c_custkey')} AS id, {address('C', 'c_custkey')} AS address FROM {{customer}}"
    ),
    "idx_classic_vault": _indexed("cv", "m < 6 AND k % 7 <> 0"),
    "idx_clm_manager": _indexed("cm", "m IN (6, 7) AND k % 7 <> 0"),
    "idx_reward_pool": _indexed("rp", "m = 8 AND k % 7 <> 0"),
    "idx_classic_boost": _indexed("cb", "m = 9 AND k % 7 <> 0"),
    "idx_erc4626_adapter": _indexed("ad", "m = 1"),
    "idx_lst_vault": _indexed("ls", "m = 2"),
    "idx_classic_vault_strategy": _strategies("cv", "classicVault_id", "m < 6"),
    "idx_clm_strategy": _strategies("cm", "clmManager_id", "m IN (6, 7)"),
    "idx_contract_registry": (
        f"SELECT 'reg-' || {text('k')} AS id, c + 1 AS chain_id, k AS registering_event_block_number, "
        f"{PRODUCT} AS registering_event_src_address, {address('D', 'k')} AS contract_address, "
        f"p_type AS contract_name FROM {PARTS}"
    ),
    "idx_pool_rewarded_event": (
        f"SELECT 'pre-' || {text('event_id')} AS id, {chain_of('user_id')} AS chainId, "
        f"{address('FF', 'event_id', 64)} AS trxHash, 0 AS logIndex, event_id AS blockNumber, ts AS blockTimestamp, "
        f"'share-' || {text('user_id')} AS poolShareToken_id, {text(MONEY)} AS rewardAmount "
        "FROM {events} WHERE event_type = 'purchase'"
    ),
    "idx_token": (
        f"SELECT {text('c + 1')} || '-' || {PRODUCT} AS id, c + 1 AS chainId, false AS isVirtual, "
        f"{PRODUCT} AS address, 'S' || {text('k')} AS symbol, p_name AS name, 18 AS decimals FROM {PARTS}"
    ),
    "idx_token_balance": (
        f"SELECT 'tb-' || {text('c_custkey')} AS id, c_nationkey % 20 + 1 AS chainId, "
        f"case when c_custkey % 10 = 0 then 'acc-x' else 'acc-' || {text('c_custkey')} end AS account_id, "
        "'t' AS token_id, '1' AS amount FROM {customer}"
    ),
    "idx_token_balance_change": (
        f"SELECT 'tbc-' || {text('event_id')} AS id, {chain_of('user_id')} AS chainId, 'tb' AS tokenBalance_id, "
        f"'acc-' || {text('event_id % 150')} AS account_id, "
        f"{text(chain_of('user_id'))} || '-' || {address('A', 'user_id')} AS token_id, "
        f"{address('FF', 'event_id - event_id % 3', 64)} AS trxHash, event_id % 3 AS logIndex, "
        f"event_id AS blockNumber, ts AS blockTimestamp, {text(MONEY)} AS balanceBefore, "
        f"{text(MONEY + ' + cast(event_id % 100 as decimal(18,2))')} AS balanceAfter "
        "FROM {events}"
    ),
}


# Derived row by row from the largest table; its staging shuffles every row anyway, which shares them out.
IN_PLACE = frozenset({"db_harvests"})
LARGE = frozenset(
    {
        "db_zap_records",
        "db_zap_parent_transactions",
        "db_zap_token_transfers",
        "idx_token_balance_change",
    }
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: When a row of a driver table has arrived: up to 21 hours after its time.
ARRIVAL = {"events": "ts + make_interval(0, 0, 0, 0, cast(event_id % 20 as int), 0, 0)", "lineitem": "l_shipdate + make_interval(0, 0, 0, 0, l_linenumber * 3, 0, 0)"}


def raw_table(spark: SparkSession, sf_dir: str, name: str, arrived: datetime | None = None) -> DataFrame:
    """A raw table; with ``arrived`` as it stood at that time, without the rows that were still to come."""
    sql = RAW_SQL[name]
    used = {t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    if arrived is not None:
        used = {t: rows.where(f"{ARRIVAL[t]} <= timestamp_ntz '{arrived}'") if t in ARRIVAL else rows for t, rows in used.items()}
    return spark.sql(sql, **used)


def duckdb_sql(name: str) -> str:
    return RAW_SQL[name].format(**{t: t for t in TABLES})


def warehouse(spark: SparkSession, sf_dir: str, as_of: datetime = EVENTS_AS_OF) -> Warehouse:
    """The warehouse over one driver folder.

    Stored tables are built once per session and folder, as a scheduled run
    would leave them for the models that follow. Raw harvests are read where they
    are, each model only the columns it needs; the other tables are copied first.
    """
    ensure_wide(ensure_utc(spark))
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        raw = {
            name: (lambda session, name=name: raw_table(session, sf_dir, name)) for name in RAW_SQL
        }
        _WAREHOUSES[key] = Warehouse(spark, as_of, raw, land_raw=True, spread=LARGE, in_place=IN_PLACE)
    return _WAREHOUSES[key].at(as_of)


def narrow_warehouse(spark: SparkSession, sf_dir: str, as_of: datetime, columns: dict[str, tuple[str, ...]]) -> Warehouse:
    """The warehouse of a run that reads only these columns of the models named. Raw tables are read where they are."""
    key = (spark.sparkContext.applicationId, sf_dir, *sorted(columns.items()))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = replace(warehouse(spark, sf_dir), land_raw=False, columns=columns, _plans={}, _tables={})
    return _WAREHOUSES[key].at(as_of)


def warehouse_at(spark: SparkSession, sf_dir: str, arrived: datetime) -> Warehouse:
    """The warehouse as a run at ``arrived`` finds it: rows that come later are not there yet. Nothing is landed."""
    raw = {name: (lambda session, name=name: raw_table(session, sf_dir, name, arrived)) for name in RAW_SQL}
    return replace(warehouse(spark, sf_dir, arrived), raw=raw, land_raw=False)


_WAREHOUSES: dict[tuple, Warehouse] = {}
