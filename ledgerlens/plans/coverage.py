"""Coverage gaps: products on indexed chains that the indexer does not know."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.filters import drop_listed
from ledgerlens.operators.joins import anti_join_keys, semi_join_keys
from ledgerlens.plans.dimensions import (
    chain,
    product_classic,
    product_classic_boost,
    product_clm,
    product_reward_pool,
)
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse

# Boosts that were listed but never used.
NEVER_USED = [
    (56, "0x53ea5c5cb2f3b5ae6c88fdaf453c2f816d777ceb"),
    (2222, "0x3c9c884efab85c44d675039de227b3dd275c360e"),
]


def indexed_chains(w: Warehouse) -> DataFrame:
    """Chains for which the indexer holds balances of known accounts."""
    balances = staging(w, "idx_token_balance").select("network_id", "account_id")
    known = semi_join_keys(balances, staging(w, "idx_account"), [("account_id", "id")])
    chains = w.model(chain).select("network_id", "chain_id")
    return known.select("network_id").distinct().join(chains, "network_id")


def missing_products_in_index(w: Warehouse) -> DataFrame:
    kinds = [
        (product_classic, "vault_address", "idx_classic_vault"),
        (product_clm, "vault_address", "idx_clm_manager"),
        (product_reward_pool, "reward_pool_address", "idx_reward_pool"),
        (product_classic_boost, "boost_address", "idx_classic_boost"),
    ]
    chains = w.model(chain).select("chain_id", "chain_name")
    covered = semi_join_keys(chains, w.model(indexed_chains), [("chain_id", "chain_id")])
    branches = []
    for build, address, index in kinds:
        rows = w.model(build).select(
            "chain_id",
            F.col(address).alias("product_address"),
            "product_key",
            "display_name",
            "is_active",
            "declared_creation_date",
            F.lit(index).alias("missing_in_model"),
        )
        known = [("chain_id", "network_id"), ("product_address", "address")]
        branches.append(anti_join_keys(rows.join(covered, "chain_id"), staging(w, index), known))
    missing = reduce(DataFrame.unionByName, branches)
    return drop_listed(missing, NEVER_USED, ["chain_id", "product_address"])
