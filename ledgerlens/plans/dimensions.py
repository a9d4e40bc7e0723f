"""Dimension tables: chains, platforms, tokens, products, bundles, accounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.aggregates import first_distinct_values, json_objects
from ledgerlens.operators.joins import anti_join_keys, join_either_key
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse

DEAD_ADDRESS = "0x000000000000000000000000000000000000dead"


def chain(w: Warehouse) -> DataFrame:
    """One row per chain. Without an end of life a chain is enabled; else the database flag, then the UI flag, decides."""
    ui = staging(w, "files_ui_chains").alias("ui")
    db = staging(w, "db_chains").select("network_id", F.col("enabled").alias("db_enabled"))
    enabled = (
        F.when(F.col("eol_date_time").isNull(), F.lit(True))
        .when(F.col("db_enabled").isNotNull(), F.col("db_enabled"))
        .when(F.col("ui_disabled").isNotNull(), ~F.col("ui_disabled"))
        .otherwise(F.lit(False))
    )
    return ui.join(db, "network_id", "left").select(
        F.col("network_id").alias("chain_id"),
        "network_id",
        fn.default_text(F.col("name")).alias("chain_name"),
        fn.network_key(F.col("chain_key")).alias("chain_key"),
        enabled.alias("is_enabled"),
        F.col("rpc").alias("public_rpc_urls"),
        "explorer_url",
        "multicall3_address",
        F.col("app_multicall_contract_address").alias("ui_lens_address"),
        "gas_type",
        "eol_date_time",
    )


def platform(w: Warehouse) -> DataFrame:
    return staging(w, "files_platforms").select(
        F.col("id").alias("platform_id"),
        F.col("name").alias("platform_name"),
        "website",
        "twitter",
        "documentation",
        "description",
        F.col("type").alias("platform_type"),
        "risks",
    )


def token(w: Warehouse) -> DataFrame:
    """Tokens per chain; of several raw rows for one address the first by id is kept."""
    chains = w.model(chain).select("chain_id", "chain_key")
    rows = staging(w, "api_tokens").join(chains, "chain_key").select(
        "chain_id",
        fn.representation_address(F.col("address")).alias("representation_address"),
        F.when(F.col("type") == "erc20", F.col("address")).alias("erc20_address"),
        F.coalesce(F.col("type") == "native", F.lit(False)).alias("is_native"),
        "symbol",
        "name",
        "decimals",
        F.col("id").alias("_id"),
    )
    first = Window.partitionBy("chain_id", "representation_address").orderBy(
        "_id", F.col("erc20_address").asc_nulls_last(), "symbol", "name", "decimals"
    )
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_id")


def _strategies(parents: DataFrame, strategies: DataFrame, parent_id: str) -> DataFrame:
    """Usable strategies of each parent contract as JSON, '[]' when there are none."""
    block = fn.safe_bigint(F.col("initialized_block"))
    usable = strategies.where(
        (F.col("address") != "")
        & block.isNotNull()
        & (F.col("initialized_timestamp") >= F.lit("2020-01-01").cast("timestamp_ntz"))
    )
    listed = json_objects(
        usable,
        [parent_id],
        {
            "address": F.col("address"),
            "initialized_block": block,
            "initialized_timestamp": F.date_format("initialized_timestamp", "yyyy-MM-dd HH:mm:ss.SSS"),
        },
        "strategies_json",
    )
    return parents.join(listed, parents["id"] == listed[parent_id], "left").select(
        F.col("network_id").alias("chain_id"),
        F.col("address").alias("vault_address"),
        "strategies_json",
    )


def _with_chain(w: Warehouse, vaults: DataFrame, network: str, how: str = "left") -> DataFrame:
    chains = w.model(chain).select("chain_id", F.col("chain_key").alias("_chain_key"))
    return vaults.join(chains, vaults[network] == chains["_chain_key"], how).drop("_chain_key")


def _with_creation(vaults: DataFrame, indexed: DataFrame, address: str) -> DataFrame:
    made = indexed.select(
        F.col("network_id").alias("chain_id"),
        F.col("address").alias(address),
        F.col("initialized_block").alias("creation_block"),
        F.col("initialized_timestamp").alias("creation_datetime"),
    )
    return vaults.join(made, ["chain_id", address], "left")


def _listing(address: str) -> list[Column]:
    """Columns every listed product shares."""
    return [
        F.col("earn_contract_address").alias(address),
        F.col("id").alias("product_key"),
        F.coalesce("oracle_id", "id").alias("price_oracle_key"),
        F.col("name").alias("display_name"),
        "platform_id",
        F.coalesce(F.col("status") == "active", F.lit(False)).alias("is_active"),
        fn.unix_timestamp_or_null(F.col("created_at")).alias("declared_creation_date"),
    ]


def product_classic(w: Warehouse) -> DataFrame:
    vaults = _with_chain(w, staging(w, "api_vaults").where(~F.col("is_gov_vault")), "network")
    vaults = vaults.select(
        "chain_id",
        *_listing("vault_address"),
        F.col("strategy").alias("latest_strategy_address"),
        fn.representation_address(F.col("token_address")).alias("underlying_token_representation_address"),
    )
    indexed = staging(w, "idx_classic_vault")
    strategies = _strategies(indexed, staging(w, "idx_classic_vault_strategy"), "classic_vault_id")
    return (
        _with_creation(vaults, indexed, "vault_address")
        .join(strategies, ["chain_id", "vault_address"], "left")
        .withColumn("strategies_json", F.coalesce(F.nullif("strategies_json", F.lit("")), F.lit("[]")))
    )


def product_clm(w: Warehouse) -> DataFrame:
    vaults = _with_chain(w, staging(w, "api_clm_vaults").where(~F.col("is_gov_vault")), "network")
    vaults = vaults.select(
        "chain_id",
        *_listing("vault_address"),
        F.col("strategy").alias("latest_strategy_address"),
        F.col("token_address").alias("lp_token_representation_address"),
        fn.address_list(F.col("deposit_token_addresses")).alias(
            "underlying_token_representation_addresses"
        ),
    )
    indexed = staging(w, "idx_clm_manager")
    strategies = _strategies(indexed, staging(w, "idx_clm_strategy"), "clm_manager_id")
    return (
        _with_creation(vaults, indexed, "vault_address")
        .join(strategies, ["chain_id", "vault_address"], "left")
        .withColumn("strategies_json", F.coalesce(F.nullif("strategies_json", F.lit("")), F.lit("[]")))
    )


def product_reward_pool(w: Warehouse) -> DataFrame:
    pools = _with_chain(w, staging(w, "api_gov_vaults").where(F.col("version") == 2), "network")
    pools = pools.select(
        "chain_id",
        *_listing("reward_pool_address"),
        F.col("token_address").alias("underlying_product_address"),
        fn.address_list(F.col("earned_token_addresses")).alias("reward_token_representation_addresses"),
    )
    return _with_creation(pools, staging(w, "idx_reward_pool"), "reward_pool_address")


def product_classic_boost(w: Warehouse) -> DataFrame:
    first_version = F.col("version").isNull() | (F.col("version") < 2)
    boosts = _with_chain(w, staging(w, "api_boosts").where(first_version), "chain", "inner")
    underlying = fn.representation_address(F.col("underlying_token_address"))
    boosts = boosts.select(
        "chain_id",
        F.col("boost_contract_address").alias("boost_address"),
        F.col("id").alias("product_key"),
        F.col("id").alias("display_name"),
        F.coalesce(F.col("status") == "active", F.lit(False)).alias("is_active"),
        underlying.alias("underlying_token_representation_address"),
        fn.representation_address(F.col("reward_token_address")).alias("reward_token_representation_address"),
    )
    classic = w.model(product_classic).select(
        "chain_id",
        F.col("vault_address").alias("underlying_token_representation_address"),
        F.col("price_oracle_key").alias("_vault_oracle"),
    )
    return (
        _with_creation(boosts, staging(w, "idx_classic_boost"), "boost_address")
        .join(classic, ["chain_id", "underlying_token_representation_address"], "left")
        .withColumn("price_oracle_key", F.coalesce("_vault_oracle", "product_key"))
        .withColumn("declared_creation_date", F.lit(None).cast("timestamp_ntz"))
        .drop("_vault_oracle")
    )


def product(w: Warehouse) -> DataFrame:
    """All products of the four kinds."""
    kinds = [
        ("classic_vault", product_classic, "vault_address"),
        ("clm_manager", product_clm, "vault_address"),
        ("reward_pool", product_reward_pool, "reward_pool_address"),
        ("classic_boost", product_classic_boost, "boost_address"),
    ]
    branches = []
    for kind, build, address in kinds:
        rows = w.model(build)
        platform_id = F.col("platform_id") if "platform_id" in rows.columns else F.lit(None).cast("string")
        branches.append(
            rows.select(
                "chain_id",
                F.lit(kind).alias("product_type"),
                F.col(address).alias("product_address"),
                "product_key",
                "price_oracle_key",
                "display_name",
                "is_active",
                platform_id.alias("platform_id"),
                "creation_block",
                "creation_datetime",
                "declared_creation_date",
            )
        )
    return reduce(DataFrame.unionByName, branches)


_BUNDLE_KEYS = [
    "chain_id",
    "bundle_root_product_address",
    "bundle_type",
    "is_active",
    "product_key",
    "display_name",
    "platform_id",
    "creation_block",
    "creation_datetime",
]
BUNDLE_SIZE = 10


def _bundle(roots: DataFrame, pools: DataFrame, boosts: DataFrame) -> DataFrame:
    """Roots with up to ten reward pools and boosts each; members come as (root key, address)."""
    members = ["chain_id", "_root"]
    pool_lists = first_distinct_values(
        pools, members, "reward_pool_address", "reward_pool_addresses", BUNDLE_SIZE
    )
    boost_lists = first_distinct_values(
        boosts, members, "boost_address", "classic_boost_addresses", BUNDLE_SIZE
    )
    empty = fn.typed_empty_array("string")
    return (
        roots.join(pool_lists, members, "left")
        .join(boost_lists, members, "left")
        .select(
            *_BUNDLE_KEYS,
            F.coalesce("reward_pool_addresses", empty).alias("reward_pool_addresses"),
            F.coalesce("classic_boost_addresses", empty).alias("classic_boost_addresses"),
        )
    )


def product_bundle(w: Warehouse) -> DataFrame:
    """A root product with its reward pools and boosts.

    A CLM bundle is rooted at the classic vault wrapping the CLM, if any; the
    other classic vaults root bundles of their own.
    """
    clm, classic = w.model(product_clm), w.model(product_classic)
    pools, boosts = w.model(product_reward_pool), w.model(product_classic_boost)

    wrappers = classic.select(
        "chain_id",
        F.col("underlying_token_representation_address").alias("vault_address"),
        F.col("vault_address").alias("_wrapper"),
    )
    kept = ["chain_id", "is_active", "product_key", "display_name", "platform_id", "creation_block", "creation_datetime"]
    clm_roots = clm.join(wrappers, ["chain_id", "vault_address"], "left").select(
        *kept,
        F.lit("clm_bundle").alias("bundle_type"),
        fn.if_blank(F.col("_wrapper"), F.col("vault_address")).alias("bundle_root_product_address"),
        "vault_address",
        "_wrapper",
        F.concat_ws("|", "vault_address", F.coalesce("_wrapper", F.lit(""))).alias("_root"),
    ).distinct()
    pool_keys = pools.select(
        F.col("chain_id").alias("_pool_chain"), "underlying_product_address", "reward_pool_address"
    )
    clm_pools = join_either_key(
        clm_roots,
        pool_keys,
        [("chain_id", "_pool_chain")],
        [
            ("vault_address", "underlying_product_address"),
            ("_wrapper", "underlying_product_address"),
        ],
    )
    boost_keys = boosts.select(
        "chain_id",
        F.col("underlying_token_representation_address").alias("vault_address"),
        "boost_address",
    )
    clm_bundles = _bundle(clm_roots, clm_pools, clm_roots.join(boost_keys, ["chain_id", "vault_address"]))

    classic_roots = anti_join_keys(
        classic.select(
            *kept,
            F.lit("classic_bundle").alias("bundle_type"),
            F.col("vault_address").alias("bundle_root_product_address"),
            "vault_address",
            F.col("vault_address").alias("_root"),
        ),
        clm_roots,
        [("chain_id", "chain_id"), ("vault_address", "bundle_root_product_address")],
    ).distinct()
    classic_pools = pools.select(
        "chain_id", F.col("underlying_product_address").alias("_root"), "reward_pool_address"
    )
    classic_boosts = boost_keys.withColumnRenamed("vault_address", "_root")
    return clm_bundles.unionByName(_bundle(classic_roots, classic_pools, classic_boosts))


def address_activity(w: Warehouse) -> DataFrame:
    """Balance-change activity per address."""
    changes = staging(w, "idx_token_balance_change").select(
        "account_id", "block_timestamp", "trx_hash", "token_id"
    )
    accounts = staging(w, "idx_account").select(F.col("id").alias("account_id"), "address")
    seen = fn.epoch_to_null(F.col("block_timestamp"))
    return (
        changes.join(accounts, "account_id")
        .groupBy("address")
        .agg(
            F.min(seen).alias("first_activity_timestamp"),
            F.max(seen).alias("last_activity_timestamp"),
            F.count(F.lit(1)).alias("total_balance_changes"),
            F.count_distinct("trx_hash").alias("unique_transactions"),
            F.count_distinct("token_id").alias("unique_tokens"),
        )
    )


def _address_sources(w: Warehouse) -> list[DataFrame]:
    """(chain_id, address, label, is_contract) from everywhere an address is mentioned."""

    def rows(
        df: DataFrame,
        address: str,
        label: str | None,
        is_contract: bool,
        chain_id: str = "chain_id",
        native: bool = True,
    ) -> DataFrame:
        named = df.select(
            F.col(chain_id).alias("chain_id"),
            F.col(address).alias("address"),
            (F.lit(label) if label else F.lit(None)).cast("string").alias("label"),
            F.lit(is_contract).alias("is_contract"),
        ).where(F.col("address") != "")
        return named if native else named.where(F.col("address") != fn.NATIVE_ADDRESS)

    chains = w.model(chain).select("chain_id", "network_id")
    clm, classic = w.model(product_clm), w.model(product_classic)
    pools, boosts = w.model(product_reward_pool), w.model(product_classic_boost)
    records = staging(w, "db_zap_records")
    parents = staging(w, "db_zap_parent_transactions")
    transfers = staging(w, "db_zap_token_transfers")
    accounts = staging(w, "idx_account").select(F.col("id").alias("account_id"), "address")
    active = staging(w, "idx_token_balance_change").select("account_id", "network_id").distinct()

    products = w.model(product).select(
        "chain_id",
        F.col("product_address").alias("address"),
        F.col("product_type").alias("label"),
        F.lit(True).alias("is_contract"),
    )
    metadata = (
        staging(w, "db_address_metadata")
        .where(F.col("is_contract") | F.col("label").isNotNull())
        .join(chains, "network_id", "left")
        .select("chain_id", "address", "label", "is_contract")
    )

    def strategy_rows(name: str, label: str) -> DataFrame:
        return rows(staging(w, name).join(chains, "network_id", "left"), "address", label, True)

    def exploded(df: DataFrame, array: str) -> DataFrame:
        return df.select("chain_id", F.explode(array).alias("address"))

    special = chains.select(
        "chain_id",
        F.explode(
            F.array(
                F.struct(F.lit(fn.NATIVE_ADDRESS).alias("address"), F.lit("zero_address").alias("label")),
                F.struct(F.lit(DEAD_ADDRESS).alias("address"), F.lit("dead_address").alias("label")),
            )
        ).alias("_s"),
    ).select("chain_id", "_s.address", "_s.label", F.lit(False).alias("is_contract"))

    return [
        products.where(F.col("address") != ""),
        strategy_rows("idx_clm_strategy", "clm_strategy"),
        strategy_rows("idx_classic_vault_strategy", "classic_vault_strategy"),
        rows(w.model(token), "erc20_address", "erc20", True),
        rows(
            exploded(clm, "underlying_token_representation_addresses"),
            "address",
            "underlying_token",
            True,
            native=False,
        ),
        rows(clm, "lp_token_representation_address", "lp_token", True, native=False),
        rows(classic, "underlying_token_representation_address", "smart_contract", True, native=False),
        rows(boosts, "underlying_token_representation_address", "underlying_token", True, native=False),
        rows(boosts, "reward_token_representation_address", "reward_token", True, native=False),
        rows(
            exploded(pools, "reward_token_representation_addresses"),
            "address",
            "reward_token",
            True,
            native=False,
        ),
        metadata,
        special,
        rows(active.join(accounts, "account_id"), "address", None, False, "network_id"),
        rows(records, "caller_address", None, False, "network_id"),
        rows(records, "recipient_address", None, False, "network_id"),
        rows(parents, "from_address", None, False, "network_id"),
        rows(parents, "to_address", "smart_contract", True, "network_id"),
        rows(transfers, "token_address", "erc20", True, "network_id", native=False),
    ]


def account(w: Warehouse) -> DataFrame:
    """Every known address with its labels, chains and activity.

    Mentions are reduced to distinct tuples before anything is collected, so an
    address mentioned by a large share of all rows contributes one row per
    input partition and tuple.
    """
    mentions = reduce(DataFrame.unionByName, _address_sources(w)).where(F.col("address").isNotNull())
    known = mentions.distinct().groupBy("address").agg(
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.sort_array(F.collect_set("chain_id")).alias("active_chain_ids"),
        F.bool_or("is_contract").alias("is_contract"),
    )
    counts = ["total_balance_changes", "unique_transactions", "unique_tokens"]
    return known.join(w.model(address_activity), "address", "left").select(
        "address",
        "labels",
        F.coalesce("is_contract", F.lit(False)).alias("is_contract"),
        "active_chain_ids",
        "first_activity_timestamp",
        "last_activity_timestamp",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
