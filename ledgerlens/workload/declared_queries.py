"""Registered queries: the tests declared for the models, run together, and the keys without a parent.

Each declaration gives the library's test and the SQL that counts the same violations.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.quality import declared
from ledgerlens.quality.declared import Suite, Test
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, SHIP_AS_OF, narrow_warehouse, warehouse
from ledgerlens.workload.model_queries import MODELS
from ledgerlens.workload.oracle_models import with_models

#: A test and the SQL of its violations; ``{m}`` stands for the model.
Declared = tuple[Test, str]


def _filled(*columns: str) -> list[Declared]:
    return [(t, f"(SELECT count(*) FROM {{m}} WHERE {c} IS NULL)") for t, c in zip(declared.not_null(*columns), columns, strict=True)]


def _unique(*columns: str) -> Declared:
    keys, whole = ", ".join(columns), " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return declared.unique(*columns), f"(SELECT count(*) FROM (SELECT {keys} FROM {{m}} WHERE {whole} GROUP BY {keys} HAVING count(*) > 1))"


def _distinct(column: str, above: int) -> Declared:
    return declared.distinct_above(column, above), f"(SELECT CAST(count(DISTINCT {column}) <= {above} AS BIGINT) FROM {{m}})"


def _range(column: str, low: int, high: int) -> Declared:
    return declared.in_range(column, low, high), f"(SELECT count(*) FROM {{m}} WHERE {column} < {low} OR {column} > {high})"


def _one_of(column: str, *values: str) -> Declared:
    listed = ", ".join(f"'{v}'" for v in values)
    return declared.one_of(column, *values), f"(SELECT count(*) FROM {{m}} WHERE {column} NOT IN ({listed}))"


def _holds(name: str, condition: str, sql: str = "") -> Declared:
    return declared.holds(name, condition), f"(SELECT count(*) FROM {{m}} WHERE NOT coalesce({sql or condition}, false))"


def _one_row() -> Declared:
    return declared.one_row(), "(SELECT CAST(count(*) <> 1 AS BIGINT) FROM {m})"


def _day(column: str, as_of: datetime, days_ago: int) -> Declared:
    day = as_of.date() - timedelta(days=days_ago)
    sql = f"(SELECT CAST(count(*) = 0 AS BIGINT) FROM {{m}} WHERE CAST({column} AS DATE) = DATE '{day}')"
    return declared.day_present(column, as_of.date(), days_ago), sql


def _foreign(parent: str, array: str | None = None, **pairs: str) -> Declared:
    sql = f"(SELECT coalesce(sum(n_rows), 0) FROM ({_orphans(parent, array, pairs)}))"
    return declared.foreign_key(parent, pairs, array), sql


def _orphans(parent: str, array: str | None, pairs: dict[str, str]) -> str:
    own = ", ".join(f"unnest({c}) AS k{i}" if c == array else f"{c} AS k{i}" for i, c in enumerate(pairs))
    whole = " AND ".join(f"k{i} IS NOT NULL" for i in range(len(pairs)))
    same = " AND ".join(f"p.{theirs} = c.k{i}" for i, theirs in enumerate(pairs.values()))
    keys = ", ".join(f"k{i}" for i in range(len(pairs)))
    text = " || '|' || ".join(f"CAST(k{i} AS VARCHAR)" for i in range(len(pairs)))
    return (
        f"SELECT {text} AS key, count(*) AS n_rows FROM (SELECT {own} FROM {{m}}) c "
        f"WHERE {whole} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same}) GROUP BY {keys}"
    )


_PRODUCT = {"chain_id": "chain_id", "product_address": "product_address"}
_ENTITY_HOUR = ("chain_id", "product_address", "date_hour")
_TYPES = ("classic_vault", "clm_manager", "reward_pool", "classic_boost")
_LISTED = [
    *_filled("chain_id", "product_key", "display_name", "is_active", "declared_creation_date"),
    _holds("creation_block", "creation_block IS NULL OR creation_block <> 0"),
    _holds("creation_datetime", "creation_datetime IS NULL OR creation_datetime >= TIMESTAMP '2020-01-01 00:00:00'"),
    _foreign("chain", chain_id="chain_id"),
]

#: What must hold for each model.
DECLARED: dict[str, list[Declared]] = {
    "chain": [
        *_filled("chain_id", "network_id", "chain_name", "chain_key", "is_enabled", "explorer_url"),
        _unique("chain_id"),
        _distinct("chain_id", 10),
    ],
    "platform": [*_filled("platform_id", "platform_name", "website"), _unique("platform_id"), _distinct("platform_type", 4)],
    "token": [
        *_filled("chain_id", "representation_address", "is_native", "symbol", "name", "decimals"),
        _unique("chain_id", "representation_address"),
        _range("decimals", 0, 18),
        _foreign("chain", chain_id="chain_id"),
    ],
    "product_classic": [
        *_LISTED,
        _unique("chain_id", "vault_address"),
        _foreign("platform", platform_id="platform_id"),
        _foreign("token", chain_id="chain_id", underlying_token_representation_address="representation_address"),
    ],
    "product_clm": [
        *_LISTED,
        _unique("chain_id", "vault_address"),
        _foreign(
            "token",
            "underlying_token_representation_addresses",
            chain_id="chain_id",
            underlying_token_representation_addresses="representation_address",
        ),
    ],
    "product": [
        *_LISTED,
        *_filled("product_address", "platform_id"),
        _unique("chain_id", "product_address"),
        _unique("product_key"),
        _one_of("product_type", *_TYPES),
        _foreign("platform", platform_id="platform_id"),
    ],
    "account": [
        *_filled("address", "labels", "is_contract", "active_chain_ids", "total_balance_changes"),
        _unique("address"),
        _holds("active_chain_ids", "size(active_chain_ids) > 0", "len(active_chain_ids) > 0"),
        _foreign("chain", "active_chain_ids", active_chain_ids="chain_id"),
    ],
    "tvl_hourly": [*_filled(*_ENTITY_HOUR), _unique(*_ENTITY_HOUR), _range("tvl_usd", 0, 200000), _foreign("product", **_PRODUCT)],
    "apy_hourly": [*_filled(*_ENTITY_HOUR), _unique(*_ENTITY_HOUR), _range("apy", 0, 1), _foreign("product", **_PRODUCT)],
    "product_stats": [
        *_filled(*_ENTITY_HOUR, "product_type", "tvl_usd"),
        _unique(*_ENTITY_HOUR),
        _unique("product_address"),
        _one_of("product_type", *_TYPES),
        _foreign("chain", chain_id="chain_id"),
        _foreign("platform", platform_id="platform_id"),
        _foreign("product", **_PRODUCT),
        _foreign("token", "breakdown_tokens", chain_id="chain_id", breakdown_tokens="representation_address"),
    ],
    "product_tvl_diff": [
        *_filled("chain_id", "product_address", "product_type", "ref_hour", "tvl_usd_diff_1y"),
        _unique("chain_id", "product_address"),
        _foreign("product", **_PRODUCT),
    ],
    "harvests": [
        *_filled("txn_timestamp", "chain_id", "product_address", "txn_hash"),
        _unique("chain_id", "block_number", "txn_idx", "event_idx"),
        _unique("txn_hash"),
        _foreign("product", **_PRODUCT),
    ],
    "revenue_buyback_events": [
        *_filled("id", "chain_id", "buyback_usd"),
        _unique("id"),
        _range("buyback_amount", 0, 90),
        _foreign("token", chain_id="chain_id", token_representation_address="representation_address"),
    ],
    "daily_revenue_summary": [
        *_filled("date_day", "yield_usd"),
        _unique("date_day"),
        _day("date_day", SHIP_AS_OF, 5),
        _day("date_day", SHIP_AS_OF, 1500),
    ],
    "api_revenue_summary": [_one_row()],
    "raw_idx_token_balance": [*_filled("id"), _unique("account_id"), _foreign("raw_idx_account", account_id="id"), _one_row()],
    "raw_idx_account": [*_filled("id", "address"), _unique("id")],
}
#: Declared columns and types of whole models.
CONTRACTS: dict[str, dict[str, str]] = {
    "daily_revenue_summary": {
        "date_day": "date",
        "yield_usd": "decimal(38,18)",
        "revenue_usd": "decimal(38,18)",
        "buyback_usd": "decimal(38,18)",
    },
    # Declared without ``risks``, so that the contract finds one difference.
    "platform": dict.fromkeys(
        ("platform_id", "platform_name", "website", "twitter", "documentation", "description", "platform_type"), "string"
    ),
}
_DIFFERENCES = {"daily_revenue_summary": 0, "platform": 1}
#: What the foreign keys read of the large models, directly or through hourly tables and TVL changes.
KEY_COLUMNS = {
    "product_harvests": ("txn_timestamp", "chain_id", "product_address", "harvest_amount", "want_price"),
    "product_stats": ("chain_id", "product_address", "platform_id", "date_hour", "tvl_usd", "breakdown_tokens"),
    "account": ("active_chain_ids",),
}


def _models(at: Callable[[datetime], Warehouse]) -> dict[str, DataFrame]:
    found = {}
    for name in DECLARED:
        if name.startswith("raw_"):
            found[name] = at(EVENTS_AS_OF).table(name.removeprefix("raw_"))
        else:
            model = MODELS[name]
            found[name] = at(model.as_of).model(model.build)
    return found


def _suites() -> dict[str, Suite]:
    return {name: Suite([t for t, _ in tests], CONTRACTS.get(name, {})) for name, tests in DECLARED.items()}


def declared_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of every declared test of every model."""
    return declared.violations(_models(lambda as_of: warehouse(spark, sf_dir, as_of)), _suites())


def foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys without a parent row, of every declared foreign key, with the number of rows that name them."""
    models = _models(lambda as_of: narrow_warehouse(spark, sf_dir, as_of, KEY_COLUMNS))
    orphans = declared.orphan_keys(models, _suites())
    return orphans.select("model", "test", F.array_join("key", "|").alias("key"), "n_rows")


def _tests_sql() -> str:
    parts = [
        f"SELECT '{model}' AS model, '{test.test}' AS test, {sql.format(m=model)} AS violations"
        for model, tests in DECLARED.items()
        for test, sql in tests
    ]
    parts += [f"SELECT '{model}', 'contract', {n}" for model, n in _DIFFERENCES.items()]
    return with_models("SELECT model, test, CAST(violations AS BIGINT) AS violations FROM (" + " UNION ALL ".join(parts) + ") AS v")


def _keys_sql() -> str:
    parts = []
    for model, tests in DECLARED.items():
        for test, _ in tests:
            if isinstance(test, declared.ForeignKey):
                inner = _orphans(test.parent, test.array, dict(test.pairs)).format(m=model)
                parts.append(f"SELECT '{model}' AS model, '{test.test}' AS test, key, n_rows FROM ({inner}) AS o")
    return with_models("SELECT * FROM (" + " UNION ALL ".join(parts) + ") AS v")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"dq_declared_tests": declared_tests, "dq_foreign_keys": foreign_keys}


def oracles() -> dict[str, str]:
    return {"dq_declared_tests": _tests_sql(), "dq_foreign_keys": _keys_sql()}
