"""Zap transactions: one scan per fact, events of one key, missing hashes, legs of other events."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as entry
from ledgerlens.plans.zaps import zap_transactions
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.workload.driver_tables import warehouse

SF = "/root/testdata/sf0.001"
AT = datetime(2024, 1, 2, 3)
PARENT = (
    "chain_id long, block_number long, txn_idx int, txn_timestamp timestamp, txn_hash string, value double, effective_gas_price long,"
    " gas_limit long, gas_used long, native_price double, from_address string, to_address string, calldata string, success boolean,"
    " created_at timestamp"
)
RECORD = (
    "chain_id long, block_number long, txn_idx int, event_idx int, txn_hash string, caller_address string, recipient_address string,"
    " source_chain_id long, target_chain_id long, vault_id string, action string, total_usd double, bridge_hash string,"
    " swap_source string, created_at timestamp, updated_at timestamp"
)
TRANSFER = (
    "chain_id long, block_number long, txn_idx int, parent_event_idx int, event_idx int, zap_type string, token_id long,"
    " token_amount double, usd_value double, token_address string, created_at timestamp, updated_at timestamp"
)


def parent(block, txn_hash, chain=1):
    return (chain, block, 0, AT, txn_hash, 0.0, 1, 1, 1, 1.0, "0xF", "0xT", "0x", True, AT)


def record(block, event, action="Deposit", usd=1.0, txn_hash=None, vault="v", chain=1):
    return (chain, block, 0, event, txn_hash, "0xC", "0xR", 1, None, vault, action, usd, None, None, AT, AT)


def transfer(block, event, leg, kind="input", usd=1.0, token=1, chain=1):
    return (chain, block, 0, event, leg, kind, token, 2.0, usd, "0xA", AT, AT)


def built(spark, parents, records, transfers):
    raw = {
        "db_zap_parent_transactions": spark.createDataFrame(parents, PARENT),
        "db_zap_records": spark.createDataFrame(records, RECORD),
        "db_zap_token_transfers": spark.createDataFrame(transfers, TRANSFER),
        "db_price_oracles": spark.createDataFrame([(1, "one", None)], "id long, oracle_id string, tokens string"),
    }
    rows = zap_transactions(Warehouse(spark, AT, raw)).collect()
    return {row.src_txn_hash: row for row in rows}


def test_events_and_legs_of_one_hash(spark):
    got = built(
        spark,
        [parent(1, "0xAA"), parent(2, "0xBB"), parent(3, "0xCC")],
        [
            record(1, 7, usd=10.0),
            record(1, 5, action="Withdrawal", usd=4.0),
            record(2, 1, action="claim", txn_hash="0xaa"),
            record(2, 2, vault=None),
            record(9, 1),
        ],
        [
            transfer(1, 7, 30, usd=2.0),
            transfer(1, 5, 20, usd=3.0, token=None),
            transfer(1, 5, 10, kind="other"),
            transfer(1, 6, 40),
            transfer(2, 1, 50, kind="output", usd=None),
            transfer(2, 2, 60),
            transfer(9, 1, 70),
        ],
    )
    assert set(got) == {"0xaa"}
    row = got["0xaa"]
    assert (row.block_number, row.event_count, row.actions) == (1, 3, ["Deposit", "Withdrawal", "claim"])
    assert row.action == "Deposit" and (float(row.total_usd), float(row.signed_usd)) == (15.0, 6.0)
    assert [float(x) for x in row.input_usd_values] == [3.0, 2.0] and row.input_token_symbols == ["", "one"]
    assert float(row.input_usd) == 5.0 and float(row.output_usd) == 0.0 and row.refund_usd_values == []


def test_repeated_rows_of_one_event_count_once(spark):
    got = built(
        spark,
        [parent(1, "0xaa"), parent(1, "0xaa")],
        [record(1, 7, usd=10.0), record(1, 7, usd=10.0), record(1, 7, usd=3.0)],
        [transfer(1, 7, 1, usd=2.0)],
    )
    row = got["0xaa"]
    assert (float(row.total_usd), row.event_count, float(row.input_usd)) == (3.0, 1, 2.0)


def test_events_without_a_hash_are_one_group_without_legs(spark):
    blocks = range(1, 400)
    got = built(
        spark,
        [parent(b, None) for b in blocks] + [parent(500, "0xaa")],
        [record(b, 1) for b in blocks] + [record(500, 1, action=None)],
        [transfer(b, 1, 1) for b in blocks],
    )
    assert set(got) == {None, "0xaa"}
    assert float(got[None].total_usd) == 399.0 and got[None].input_usd_values == []
    assert got["0xaa"].action is None and got["0xaa"].actions == []


def test_empty_tables(spark):
    assert built(spark, [], [], []) == {}


def test_null_parts_of_a_call_match_nothing(spark):
    odd = [tuple(None if i == 1 else x for i, x in enumerate(row)) for row in (parent(1, "0xaa"), record(1, 1), transfer(1, 1, 1))]
    assert built(spark, [odd[0]], [odd[1]], [odd[2]]) == {}


@pytest.mark.parametrize("fact", ["db_zap_parent_transactions", "db_zap_records", "db_zap_token_transfers"])
def test_each_fact_is_scanned_once(spark, fact):
    w = warehouse(spark, SF)
    files = w.table(fact).inputFiles()[0].rsplit("/", 1)[0].split("/")[-1]
    plan = entry.queries()["model_zap_activity"](spark, SF)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves().mkString("\n")
    assert leaves.count("Relation") >= 3
    scans = [leaf for leaf in entry_scans(plan) if files in leaf]
    assert len(scans) == 1


def entry_scans(plan):
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            found.append(leaf.relation().location().rootPaths().mkString(","))
    return found
