"""Keyed upsert: delete rows whose key is in the batch, insert the batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.merge import dedup_latest
from ledgerlens.session import materialize
from ledgerlens.sinks.versions import current_version, part_key, publish, read_folders
from ledgerlens.sinks.writers import evolve


def merged_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after the upsert. Keys compare NULL-safe, as stored keys do."""
    incoming = batch.select(*[F.col(k).alias(f"_in_{k}") for k in keys]).distinct()
    condition = None
    for k in keys:
        same = target[k].eqNullSafe(incoming[f"_in_{k}"])
        condition = same if condition is None else condition & same
    return target.join(incoming, condition, "left_anti").unionByName(batch)


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    partition_by: str | None = None,
    version: Sequence[str] | None = None,
    on_schema_change: str = "fail",
    settled: bool = False,
) -> None:
    """Upserts ``batch`` into the versioned table at ``path``.

    With ``partition_by`` (a column that is a function of the key, such as the
    day of a key timestamp) only the partitions present in the batch are read and
    written again; the new version takes over the folders of the others. Without
    it the whole table is merged.

    ``version`` names columns by which the newest row of a key wins, in the batch
    and in the table: a row older than the stored one changes nothing. With
    ``settled`` the batch is read from files already, and is not stored again.

    The table is never overwritten: a failed run leaves the version before, and a
    repeated run gives the same table.
    """
    spark = batch.sparkSession
    if version:
        batch = dedup_latest(batch, keys, version)
    stored = current_version(spark, path)
    if stored is None:
        publish(batch, path, partition_by=partition_by)
        return
    if partition_by != stored.partition_by:
        raise ValueError(f"{path} is partitioned by {stored.partition_by}, not {partition_by}")
    # The batch tells its partitions and feeds the merge; compute it once.
    batch = batch if settled else materialize(batch, "batch")
    touched = None
    if partition_by and set(batch.columns) == set(stored.schema.names):
        # One short name per partition, as many as the manifest itself may hold.
        touched = {r[0] for r in batch.select(part_key(partition_by)).distinct().collect()}
    target, batch = evolve(read_folders(spark, stored, touched), batch, on_schema_change)
    if version:
        result = dedup_latest(target.unionByName(batch), keys, version)
    else:
        result = merged_rows(target, batch, keys)
    kept = {p: f for p, f in stored.folders.items() if touched is not None and p not in touched}
    publish(result, path, partition_by=partition_by, kept=kept, based_on=stored)


def merge_into(batch: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same upsert for a catalog table whose format supports MERGE."""
    condition = None
    for k in keys:
        same = F.col(f"{table}.{k}").eqNullSafe(F.col(f"batch.{k}"))
        condition = same if condition is None else condition & same
    batch.alias("batch").mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()
