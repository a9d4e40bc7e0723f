"""Zap activity: one row per source transaction with its token legs as arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.aggregates import leg_arrays, leg_entry
from ledgerlens.operators.joins import prefixed
from ledgerlens.plans.dimensions import account, chain
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse

TXN = ["src_chain_id", "src_txn_hash"]
_CALL = ["network_id", "block_number", "txn_idx"]
_RECORD = ["caller_address", "recipient_address", "target_network_id", "product_key", "bridge_hash", "swap_source"]
_PARENT = ["success", "gas_used", "native_price", "from_address", "to_address"]
_CONTEXT = ["txn_timestamp", "txn_date", *_RECORD, *_PARENT]
_LEG_ORDER = ["transfer_event_idx", "token_address", "token_symbol", "token_amount", "usd_value"]
_LEG_VALUES = {
    "token_addresses": "token_address",
    "token_symbols": "token_symbol",
    "token_amounts": "token_amount",
    "usd_values": "usd_value",
}


def _leg_kinds(w: Warehouse) -> dict[str, str]:
    return {"input": "input", "output": "output", "zap_fee": w.fee_leg, "refund": "refund"}


def zap_calls(w: Warehouse) -> DataFrame:
    """One row per call: its parent transaction, the records of listed products and the token transfers.

    Records without a product key come from other protocols and are left out, and so are
    calls without a parent or a record. The three tables are read once and meet in one
    grouping by call; a call is one transaction, which bounds its rows.
    """
    parent = F.struct("txn_timestamp", "txn_hash", *_PARENT)
    record = F.struct("event_idx", "txn_hash", "action", "total_usd", *_RECORD)
    transfer = F.struct("parent_event_idx", leg_entry(F.col, "zap_type", _LEG_ORDER, list(_LEG_VALUES.values())).alias("leg"))
    sources = {
        "_parent": staging(w, "db_zap_parent_transactions").select(*_CALL, parent.alias("_parent")),
        "_record": staging(w, "db_zap_records").where(F.col("product_key").isNotNull()).select(*_CALL, record.alias("_record")),
        "_transfer": _transfers(w).select(*_CALL, transfer.alias("_transfer")),
    }
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), sources.values())
    return (
        rows.dropna(subset=_CALL)
        .groupBy(*_CALL)
        .agg(
            F.min("_parent").alias("_parent"),
            F.collect_list("_record").alias("_records"),
            F.collect_list("_transfer").alias("_transfers"),
        )
        .where(F.col("_parent").isNotNull() & (F.size("_records") > 0))
    )


def _transfers(w: Warehouse) -> DataFrame:
    symbols = staging(w, "db_price_oracles").select(F.col("id").alias("_token"), F.col("oracle_id").alias("token_symbol"))
    transfers = staging(w, "db_zap_token_transfers").where(F.col("zap_type").isin(*_leg_kinds(w).values())).select(
        *_CALL,
        "parent_event_idx",
        "zap_type",
        "token_address",
        "token_amount",
        "usd_value",
        F.col("event_idx").alias("transfer_event_idx"),
        F.col("token_id").cast("string").alias("_token"),
    )
    return transfers.join(symbols, "_token", "left").withColumn("token_symbol", F.coalesce("token_symbol", F.lit("")))


def zap_events(w: Warehouse) -> DataFrame:
    """Events of calls with their legs, one row per event key: of several records the first by value."""
    parent = F.col("_parent")

    def event(record: Column) -> Column:
        return F.struct(
            record["event_idx"].alias("event_idx"),
            F.coalesce(record["txn_hash"], parent["txn_hash"]).alias("txn_hash"),
            *[record[c].alias(c) for c in ("action", "total_usd", *_RECORD)],
        )

    def with_legs(found: Column) -> Column:
        mine = F.filter("_transfers", lambda transfer: transfer["parent_event_idx"] == found["event_idx"])
        # A missing hash tells nothing of which transaction the legs belong to.
        legs = F.when(found["txn_hash"].isNotNull(), fn.field_list(mine, "leg"))
        return F.struct(found.alias("event"), legs.alias("legs"))

    events = F.array_sort(F.transform("_records", event))
    calls = w.model(zap_calls).withColumn("_events", events)
    first = F.filter("_events", lambda e, i: (i == 0) | ~e["event_idx"].eqNullSafe(F.col("_events")[F.greatest(i - 1, F.lit(0))]["event_idx"]))
    each = calls.select(*_CALL, "_parent", F.inline(F.transform(first, with_legs)))
    return each.select(
        F.col("network_id").alias("src_chain_id"),
        F.col("event")["txn_hash"].alias("src_txn_hash"),
        "block_number",
        "txn_idx",
        parent["txn_timestamp"].alias("txn_timestamp"),
        F.to_date(parent["txn_timestamp"]).alias("txn_date"),
        *[F.col("event")[c].alias(c) for c in ("event_idx", "action", "total_usd", *_RECORD)],
        *[parent[c].alias(c) for c in _PARENT],
        "legs",
    )


def zap_transactions(w: Warehouse) -> DataFrame:
    """Events and legs per transaction hash; context columns come from the first event.

    All aggregates combine before the shuffle. Events without any hash are one group, as a
    NULL groups, and carry no legs.
    """
    events = w.model(zap_events)
    first = F.struct("block_number", "txn_idx", "event_idx", *_CONTEXT)
    per_hash = events.groupBy(*TXN).agg(
        F.min(first).alias("_first"),
        F.mode("action", deterministic=True).alias("action"),
        F.sort_array(F.collect_set("action")).alias("actions"),
        F.sum("total_usd").alias("total_usd"),
        F.sum(fn.signed_by_action(F.col("action"), F.col("total_usd"))).alias("signed_usd"),
        F.size(F.collect_set("event_idx")).alias("event_count"),
        F.flatten(F.collect_list("legs")).alias("_legs"),
    )
    context = per_hash.select(
        *TXN,
        *[F.col("_first")[c].alias(c) for c in ("block_number", "txn_idx", *_CONTEXT)],
        "action",
        "actions",
        "total_usd",
        "signed_usd",
        "event_count",
        *leg_arrays(F.col("_legs"), _leg_kinds(w), list(_LEG_VALUES)),
    )
    return context.withColumns({f"{name}_usd": _array_total(F.col(f"{name}_usd_values")) for name in _leg_kinds(w)})


def _array_total(values: Column) -> Column:
    zero = F.lit(0).cast(fn.AMOUNT)
    return F.aggregate(values, zero, lambda total, value: (total + F.coalesce(value, zero)).cast(fn.AMOUNT))


def zap_activity(w: Warehouse) -> DataFrame:
    chains = w.model(chain).select("chain_id", "chain_name", "chain_key", "is_enabled")
    accounts = w.model(account).select("address", "labels", "is_contract")
    src = prefixed(chains, "src_").withColumnsRenamed(
        {"src_chain_name": "src_chain_name", "src_is_enabled": "src_chain_is_enabled"}
    )
    dst = prefixed(chains, "dst_").withColumnsRenamed({"dst_is_enabled": "dst_chain_is_enabled"})
    caller = prefixed(accounts, "caller_")
    recipient = prefixed(accounts, "recipient_")
    dst_chain = F.coalesce("target_network_id", "src_chain_id")
    no_labels = fn.typed_empty_array("string")
    leg_totals = [f"{kind}_usd" for kind in _leg_kinds(w)]
    leg_lists = [f"{kind}_{suffix}" for kind in _leg_kinds(w) for suffix in _LEG_VALUES]
    return (
        w.model(zap_transactions)
        .withColumn("dst_chain_id", dst_chain)
        .join(src, "src_chain_id", "left")
        .join(dst, "dst_chain_id", "left")
        .join(caller, "caller_address", "left")
        .join(recipient, "recipient_address", "left")
        .select(
            "src_chain_id",
            "src_chain_name",
            "src_chain_key",
            "src_chain_is_enabled",
            "src_txn_hash",
            F.col("block_number").alias("src_block_number"),
            F.col("txn_idx").alias("src_txn_idx"),
            F.col("txn_timestamp").alias("src_txn_timestamp"),
            F.col("txn_date").alias("src_txn_date"),
            "dst_chain_id",
            "dst_chain_name",
            "dst_chain_key",
            "dst_chain_is_enabled",
            (F.col("dst_chain_id") == F.col("src_chain_id")).alias("is_same_chain_zap"),
            "caller_address",
            F.coalesce("caller_labels", no_labels).alias("caller_labels"),
            F.coalesce("caller_is_contract", F.lit(False)).alias("caller_is_contract"),
            "recipient_address",
            F.coalesce("recipient_labels", no_labels).alias("recipient_labels"),
            F.coalesce("recipient_is_contract", F.lit(False)).alias("recipient_is_contract"),
            "product_key",
            "action",
            "actions",
            fn.flow_direction(F.col("action")).alias("flow_direction"),
            "total_usd",
            "signed_usd",
            *leg_totals,
            *leg_lists,
            "success",
            "gas_used",
            "native_price",
            "from_address",
            "to_address",
            "bridge_hash",
            "swap_source",
            "event_count",
        )
    )
