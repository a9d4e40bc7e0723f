"""Full writes and schema changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ROWS_PER_FILE
from ledgerlens.sinks.versions import current_version, publish, read_version


def write_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Publishes ``df`` as the whole content of the versioned table at ``path``.

    Clustered by ``sort_by`` so row-group statistics can skip data: that
    range-partitions on the full sort key, which also splits a hot leading value
    over several files.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    publish(df, path, partition_by=partition_by, based_on=current_version(df.sparkSession, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version of a table."""
    return read_version(spark, path)


def append_table(df: DataFrame, path: str) -> None:
    """Adds files to a plain Parquet folder; Spark commits all of them or none."""
    df.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


class SchemaChanged(ValueError):
    """The batch and the stored table have different columns."""


def evolve(stored: DataFrame, batch: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with one schema under ``fail``, ``append_new_columns`` or ``sync_all_columns``."""
    old, new = dict(stored.dtypes), dict(batch.dtypes)
    added = [c for c in batch.columns if c not in old]
    removed = [c for c in stored.columns if c not in new]
    changed = [c for c in stored.columns if c in new and old[c] != new[c]]
    if changed or (policy == "fail" and (added or removed)):
        raise SchemaChanged(f"added {added}, removed {removed}, retyped {changed}")
    if policy not in ("fail", "append_new_columns", "sync_all_columns"):
        raise ValueError(f"unknown schema policy {policy}")
    columns = [c for c in stored.columns if c not in removed or policy != "sync_all_columns"] + added

    def shaped(df: DataFrame, types: dict[str, str]) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in columns]
        )

    types = {**new, **old}
    return shaped(stored, types), shaped(batch, types)


def union_rows(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
