"""Registered queries: every staging model over the driver tables.

The SQL answer of a plain model states each rule in the other engine's terms;
models with logic of their own add theirs below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans.staging import MODEL_NAMES, SPECS, staging
from ledgerlens.workload.driver_tables import raw_table, warehouse
from ledgerlens.workload.oracle_models import (
    network,
    repr_addr,
    repr_list,
    seconds,
    str_list,
    with_models,
)
from ledgerlens.workload.present import present, select_sql

# Rule -> (SQL over a raw column, presentation kind).
RULES_SQL: dict[str, tuple[Callable[[str], str], str]] = {
    "as_is": (lambda c: f"CAST({c} AS VARCHAR)", "x"),
    "string": (lambda c: f"CAST({c} AS VARCHAR)", "x"),
    "bigint": (lambda c: f"TRY_CAST({c} AS BIGINT)", "i"),
    "int": (lambda c: f"TRY_CAST({c} AS INTEGER)", "i"),
    "double": (lambda c: f"TRY_CAST({c} AS DOUBLE)", "d"),
    "bool": (lambda c: f"CAST({c} AS BOOLEAN)", ""),
    "flag": (lambda c: f"coalesce(CAST({c} AS BOOLEAN), false)", ""),
    "time": (lambda c: f"CAST({c} AS TIMESTAMP)", "t"),
    "decimal": (lambda c: f"TRY_CAST({c} AS DECIMAL(38,6))", "d"),
    "decimal_or_zero": (lambda c: f"coalesce(TRY_CAST({c} AS DECIMAL(38,6)), 0)", "d"),
    "millionths": (lambda c: f"CAST(coalesce({c}, '0') AS DOUBLE) / 1000000", "d"),
    "lower": (lambda c: f"lower({c})", "x"),
    "network": (network, "x"),
    "text_or_unknown": (lambda c: f"coalesce({c}, 'Unknown')", "x"),
    "null_if_empty": (lambda c: f"nullif({c}, '')", "x"),
    "string_list": (str_list, "s"),
    "address_list": (lambda c: repr_list(str_list(c)), "s"),
    "decimal_list": (lambda c: f"[CAST(x AS DECIMAL(38,6)) FOR x IN {str_list(c)}]", "n"),
    "list_text": (lambda c: f"coalesce({c}, '[]')", "x"),
    "trimmed_bigint": (lambda c: f"TRY_CAST(trim({c}) AS BIGINT)", "i"),
    "nonzero": (lambda c: f"{c} <> 0", ""),
}


@dataclass(frozen=True)
class Logic:
    """A staging model with extra columns, row filters or a source of its own."""

    where: str = "true"
    source: str = ""
    columns: tuple[str, ...] = ()
    sql: str = ""


LOGIC_SQL: dict[str, Logic] = {
    "api_apy": Logic("apy IS NOT NULL"),
    "api_share_token_prices": Logic("price IS NOT NULL"),
    "api_tokens": Logic("chain_id IS NOT NULL"),
    "api_clm_vaults": Logic(
        source="""SELECT t.* FROM raw_api_clm_vaults t JOIN clm_loads l
        ON t.chain = l.chain AND lower(t.earned_token_address) = l.tok AND t._load_id = l.load_id"""
    ),
    "api_gov_vaults": Logic(
        source=f"""SELECT t.* FROM raw_api_gov_vaults t JOIN gov_loads l
        ON {network('t.chain')} = l.chain AND lower(t.earn_contract_address) = l.addr AND t._load_id = l.load_id"""
    ),
    "db_token_buyback": Logic("buyback_total IS NOT NULL AND token_amount > 0 AND token_price > 0"),
    "db_feebatch_harvests": Logic("treasury_amt > 0"),
    "bridge_messages": Logic(
        source="""SELECT DISTINCT ON (src_network_id, src_tx_hash, src_log_index) * FROM raw_bridge_messages
        ORDER BY src_network_id, src_tx_hash, src_log_index, updated_at DESC"""
    ),
    "db_harvests": Logic(
        columns=(
            "network_id:i",
            "block_number:i",
            "txn_idx:i",
            "event_idx:i",
            "txn_timestamp:t",
            "txn_hash",
            "product_key",
            "call_fee:d",
            "gas_fee:d",
            "platform_fee:d",
            "strategist_fee:d",
            "harvest_amount:d",
            "native_price:d",
            "want_price:d",
            "is_keeper_call",
        ),
        sql="SELECT * FROM stg_harvests",
    ),
    "files_ui_chains": Logic(
        columns=(
            "network_id:i",
            "name",
            "chain_key",
            "rpc:s",
            "explorer_url",
            "multicall3_address",
            "native_token_symbol",
            "native_token_oracle_id",
            "native_token_decimals:i",
            "gas_type",
            "eol_date_time:t",
            "ui_disabled",
            "ui_new",
        ),
        sql=f"""SELECT chain_id AS network_id, name, chain_key, {str_list('rpc')} AS rpc, explorer_url,
        lower(multicall3_address) AS multicall3_address, native->>'$.symbol' AS native_token_symbol,
        native->>'$.oracleId' AS native_token_oracle_id, CAST(native->>'$.decimals' AS BIGINT) AS native_token_decimals,
        gas->>'$.type' AS gas_type, {seconds('eol')} AS eol_date_time, disabled AS ui_disabled, new AS ui_new
        FROM raw_files_ui_chains""",
    ),
    "idx_token_balance_change": Logic(
        columns=(
            "id",
            "chain_id:i",
            "account_id",
            "trx_hash",
            "log_index:i",
            "block_number:i",
            "block_timestamp:t",
            "balance_before:d",
            "balance_after:d",
            "token_contract_address",
            "share_diff:d",
        ),
        sql=f"""SELECT id, chainId AS chain_id, account_id, lower(trxHash) AS trx_hash, logIndex AS log_index,
        blockNumber AS block_number, blockTimestamp AS block_timestamp, CAST(balanceBefore AS DECIMAL(18,2)) AS balance_before,
        CAST(balanceAfter AS DECIMAL(18,2)) AS balance_after, {repr_addr("split_part(token_id, '-', 2)")} AS token_contract_address,
        CAST(balanceAfter AS DECIMAL(18,2)) - CAST(balanceBefore AS DECIMAL(18,2)) AS share_diff FROM raw_idx_token_balance_change""",
    ),
}


def _shown(spec, raw_columns: set[str]) -> list[tuple[str, str, str]]:
    return [row for row in spec if row[1] in raw_columns]


def _run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = staging(warehouse(spark, sf_dir), name)
        logic = LOGIC_SQL.get(name, Logic())
        if logic.columns:
            return present(rows, logic.columns)
        raw = set(raw_table(spark, sf_dir, name).columns)
        return present(
            rows, [f"{out}:{RULES_SQL[kind][1]}" for out, _, kind in _shown(SPECS[name], raw)]
        )

    return run


def _oracle(name: str) -> str:
    logic = LOGIC_SQL.get(name, Logic())
    if logic.sql:
        return with_models(select_sql(logic.sql, logic.columns))
    shown = _shown(SPECS[name], RAW_COLUMNS[name])
    body = ", ".join(f"{RULES_SQL[kind][0](raw)} AS {out}" for out, raw, kind in shown)
    source = f"({logic.source}) r" if logic.source else f"raw_{name} r"
    typed = f"SELECT {body} FROM {source} WHERE {logic.where}"
    return with_models(select_sql(typed, [f"{out}:{RULES_SQL[kind][1]}" for out, _, kind in shown]))


def _aliases(sql: str) -> set[str]:
    """Column names of a raw table: the aliases of its first SELECT list."""
    depth, start, items = 0, 7, []
    text = sql.split(" UNION ALL ")[0]
    for i, letter in enumerate(text):
        depth += (letter == "(") - (letter == ")")
        if depth == 0 and (letter == "," or text.startswith(" FROM ", i)):
            items.append(text[start:i].strip())
            start = i + 1
            if letter == " ":
                break
    return {item.split(" AS ")[-1].split(".")[-1].strip() for item in items}


def _raw_columns() -> dict[str, set[str]]:
    from ledgerlens.workload.driver_tables import RAW_SQL

    return {name: _aliases(sql) for name, sql in RAW_SQL.items()}


RAW_COLUMNS = _raw_columns()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f"staging_{name}": _run(name) for name in MODEL_NAMES}


def oracles() -> dict[str, str]:
    return {f"staging_{name}": _oracle(name) for name in MODEL_NAMES}
