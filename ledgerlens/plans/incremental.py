"""Scheduled runs of the incremental models: read the threshold, build from there, upsert by key.

Runs that others follow also log what they changed: ``run_source`` compares the
rows it built with the stored ones and writes the keys of those that differ to the
table's change log before it publishes them. ``run_derived`` takes the keys logged
since its own last run, reads the partitions of the source that hold them, and
recomputes its rows of these keys alone; it logs its own changes in turn. A run
that dies at any point repeats the same keys next time, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.filters import unlike_stored
from ledgerlens.plans import investor, stats
from ledgerlens.session import materialize
from ledgerlens.sinks.upsert import upsert
from ledgerlens.sinks.versions import Version, current_version, part_key, read_folders
from ledgerlens.sinks.writers import append_table, write_table
from ledgerlens.sources.catalog import Warehouse
from ledgerlens.sources.tables import read_if_there
from ledgerlens.streaming.cursors import catch_up_window, lookback_start, lookback_starts

PERIOD = "_period"
ENTITY_HOUR = (*stats.ENTITY, "date_hour")


@dataclass(frozen=True)
class Incremental:
    """A model kept as a table: its key, its time column, and how to build it from a start.

    With ``tag`` each value of that column has a start of its own. Every run goes
    ``days`` back, so rows that arrive late by less are taken in. The table is cut
    into partitions of one ``period`` each.
    """

    build: Callable[[Warehouse, object], DataFrame]
    keys: tuple[str, ...]
    ts: str
    tag: str | None = None
    tags: tuple[str, ...] = ()
    days: int = 1
    period: str = "month"


INCREMENTAL: dict[str, Incremental] = {
    "int_yield": Incremental(
        stats.int_yield,
        ("chain_id", "product_address", "block_number", "txn_idx", "event_idx", "txn_timestamp"),
        "txn_timestamp",
    ),
    "tvl_hourly": Incremental(stats.tvl_hourly, ENTITY_HOUR, "date_hour"),
    "apy_hourly": Incremental(stats.apy_hourly, ENTITY_HOUR, "date_hour"),
    "unified_hourly": Incremental(
        stats.unified_hourly, (*ENTITY_HOUR, "source"), "date_hour", "source", tuple(stats.HOURLY_SOURCES)
    ),
}


@dataclass(frozen=True)
class Derived:
    """A model that is a function of the rows of another one, group by group.

    ``build`` gets all source rows of the ``group`` columns' values that changed.
    ``ts`` is one of these columns in source and model.
    """

    source: str
    build: Callable[[Warehouse, DataFrame], DataFrame]
    keys: tuple[str, ...]
    group: tuple[str, ...]
    ts: str = "date_hour"
    period: str = "month"


DERIVED: dict[str, Derived] = {
    "product_stats": Derived("unified_hourly", stats.folded_stats, ENTITY_HOUR, ENTITY_HOUR),
    "chain_stats": Derived("product_stats", stats.chain_totals, ("chain_id", "date_hour"), ("chain_id", "date_hour")),
}


def _start(w: Warehouse, model: Incremental, stored: Version | None):
    table = None if stored is None else read_folders(w.spark, stored)
    if model.tag:
        return lookback_starts(table, model.tag, model.ts, model.tags, model.days)
    return lookback_start(table, model.ts, model.days)


def run_incremental(w: Warehouse, model: Incremental, path: str) -> int:
    """One scheduled run at ``w.as_of``; returns the number of the version it published.

    Only the periods from the start on are read, merged and written again. Running
    twice with one reference time leaves the same table.
    """
    rows = model.build(w, _start(w, model, current_version(w.spark, path)))
    rows = rows.withColumn(PERIOD, F.trunc(F.to_date(model.ts), model.period))
    upsert(rows, path, model.keys, partition_by=PERIOD)
    return current_version(w.spark, path).number


def run_until(w: Warehouse, model: Incremental, path: str, times: list[datetime]) -> DataFrame:
    """Runs at each of the times in turn; the table after the last."""
    for at in times:
        run_incremental(w.at(at), model, path)
    return stored_rows(w, path)


def stored_rows(w: Warehouse, path: str) -> DataFrame:
    return read_folders(w.spark, current_version(w.spark, path)).drop(PERIOD)


# Changes from model to model --------------------------------------------------------


def _publish_changes(rows: DataFrame, path: str, keys: tuple[str, ...], ts: str, period: str) -> int:
    """Upserts those of ``rows`` that differ from the stored ones and logs their keys; returns how many."""
    spark = rows.sparkSession
    rows = materialize(rows.withColumn(PERIOD, F.trunc(F.to_date(ts), period)), "batch")
    stored = current_version(spark, path)
    changed = rows
    if stored is not None:
        touched = {r[0] for r in rows.select(part_key(PERIOD)).distinct().collect()}
        known = touched & set(stored.folders)
        if known:
            # The period is a function of the key: rows of periods that are not stored are new and need no comparison.
            compared = part_key(PERIOD).isin(sorted(known))
            unlike = unlike_stored(rows.where(compared), read_folders(spark, stored, known), keys)
            changed = materialize(unlike.unionByName(rows.where(~compared)), "changed")
    count = changed.count()
    if count or stored is None:
        # Logged first: if the run dies before it publishes, the keys are recomputed in vain, never left out.
        number = (stored.number if stored else 0) + 1
        append_table(changed.select(*keys, PERIOD, F.lit(number).alias("run")), f"{path}-changes")
        upsert(changed, path, keys, partition_by=PERIOD, settled=True)
    return count


def run_source(w: Warehouse, model: Incremental, path: str) -> int:
    """One run of a model that others follow; returns the number of rows that are new or differ."""
    rows = model.build(w, _start(w, model, current_version(w.spark, path)))
    return _publish_changes(rows, path, model.keys, model.ts, model.period)


def _between(ts: str, low: datetime, high: datetime):
    """Literal bounds reach the scan."""
    return F.col(ts).between(*[F.lit(str(x)).cast("timestamp_ntz") for x in (low, high)])


def changed_source(w: Warehouse, model: Derived, source_path: str, path: str) -> tuple[DataFrame, int] | None:
    """(source rows of the groups changed since the last run, newest run among the changes); None if there are none."""
    progress = read_if_there(w.spark, f"{path}-progress", "run int")
    seen = progress.agg(F.max("run")).first()[0] or 0
    log = w.spark.read.parquet(f"{source_path}-changes").where(F.col("run") > seen)
    newest = log.agg(F.max("run")).first()[0]
    if newest is None:
        return None
    # The newest run of the log may not be published yet; its keys come again with the one that is.
    source = current_version(w.spark, source_path)
    groups = materialize(log.select(*model.group, PERIOD).distinct(), "changed-keys")
    span = groups.agg(F.min(model.ts).alias("low"), F.max(model.ts).alias("high")).first()
    parts = {r[0] for r in groups.select(part_key(PERIOD)).distinct().collect()}
    rows = read_folders(w.spark, source, parts).where(_between(model.ts, span.low, span.high))
    same = None
    wanted = groups.select(*[F.col(c).alias(f"_g_{c}") for c in model.group]).distinct()
    for c in model.group:
        equal = rows[c].eqNullSafe(wanted[f"_g_{c}"])
        same = equal if same is None else same & equal
    return rows.join(wanted, same, "left_semi").drop(PERIOD), min(newest, source.number)


def run_derived(w: Warehouse, model: Derived, source_path: str, path: str) -> int:
    """Recomputes the groups that changed in the source since the last run; returns the number of rows that differ."""
    found = changed_source(w, model, source_path, path)
    if found is None:
        return 0
    rows, newest = found
    count = _publish_changes(model.build(w, rows), path, model.keys, model.ts, model.period)
    append_table(w.spark.createDataFrame([(newest,)], "run int"), f"{path}-progress")
    return count


def run_chain(w: Warehouse, root: str) -> dict[str, int]:
    """One scheduled run of the hourly table and of the models derived from it; how many rows each changed."""
    counts = {"unified_hourly": run_source(w, INCREMENTAL["unified_hourly"], f"{root}/unified_hourly")}
    for name, model in DERIVED.items():
        counts[name] = run_derived(w, model, f"{root}/{model.source}", f"{root}/{name}")
    return counts


# The investor timeline in catch-up windows --------------------------------------------


def run_timeline(w: Warehouse, path: str, start: datetime = investor.HISTORY_START, carry: bool = False) -> bool:
    """One catch-up window of the historical timeline at ``path``; False if there is none to run.

    The table ``<path>-closing`` has the last price of each product before the end of
    the last window, and that end in every row (one row has no product, so an end is
    known without prices too). The next window starts there. With ``carry`` it values
    changes before its first price at the closing price instead of at zero, so that
    windows of any size give the rows of one run over all, and no window reads older
    prices again. The timeline is published first: a run that dies in between
    repeats its window.
    """
    closing = f"{path}-closing"
    stored = current_version(w.spark, closing)
    opening, low = None, start
    if stored is not None:
        before = read_folders(w.spark, stored)
        low = before.agg(F.max("window_end")).first()[0]
        opening = before.where(F.col("chain_id").isNotNull()).drop("window_end")
    low, high = catch_up_window(low, w.as_of)
    if high <= low:
        return False
    rows = investor.priced_changes(w, low, high, opening=opening if carry else None)
    version = F.lit(str(w.as_of)).cast("timestamp_ntz").alias("_version")
    rows = rows.select(version, "*").withColumn(PERIOD, F.trunc(F.to_date("datetime"), "month"))
    upsert(rows, path, investor.TIMELINE_KEY, partition_by=PERIOD, version=["_version"])
    last = investor.closing_prices(w, low, high, opening)
    no_product = w.spark.createDataFrame([tuple(None for _ in last.columns)], last.schema)
    write_table(last.union(no_product).withColumn("window_end", F.lit(str(high)).cast("timestamp_ntz")), closing)
    return True
