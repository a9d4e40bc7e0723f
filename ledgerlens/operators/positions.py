"""Distributed ordering: running totals, global ranks and exact quantiles.

A window without PARTITION BY, or with one very large partition, sorts in a
single task. Here rows are range-partitioned on the full sort key instead, so
even one huge group spreads over many tasks, and per-partition totals turn
local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def running_total(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    weight: str | None = None,
) -> DataFrame:
    """Adds ``_before`` (weight of earlier rows of the group) and ``_total`` (of the group).

    ``order`` must be a total order inside a group; without ``weight`` every row
    counts one. The range partitioning is stored once, because the offsets and
    the rows must agree on partition boundaries even when a task is rerun.
    """
    groups = list(groups)
    sort_key = [*[F.col(g).asc() for g in groups], *order]
    placed = materialize(
        df.repartitionByRange(*sort_key).withColumn("_chunk", F.spark_partition_id()),
        "ranges",
    )
    amount = F.col(weight) if weight else F.lit(1)
    chunk_totals = placed.groupBy(*groups, "_chunk").agg(F.sum(amount).alias("_chunk_weight"))
    # One row per (group, chunk): at most groups + partitions rows in all.
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    offsets = chunk_totals.select(
        *groups,
        "_chunk",
        F.coalesce(
            F.sum("_chunk_weight").over(
                whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_offset"),
        F.sum("_chunk_weight").over(whole).alias("_total"),
    )
    local = (
        Window.partitionBy(*groups, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_before", F.sum(amount).over(local) - amount)
        .join(offsets, [*groups, "_chunk"])
        .withColumn("_before", F.col("_before") + F.col("_offset"))
        .drop("_chunk", "_offset")
    )


def rank_global(
    df: DataFrame, order: Sequence[Column], name: str = "rank", groups: Sequence[str] = ()
) -> DataFrame:
    """``row_number() OVER (PARTITION BY groups ORDER BY order)`` without a single-task sort."""
    return (
        running_total(df, groups, order)
        .withColumn(name, (F.col("_before") + 1).cast("bigint"))
        .drop("_before", "_total")
    )


def rank_both_ways(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """For each measure its descending and ascending row number, NULLs last both ways.

    ``measures`` maps a label to a column; the result holds ``keys`` plus
    ``rank_<label>_gainer`` and ``rank_<label>_loser``. All measures are ranked in
    one range partitioning over (label, value, keys). Ties go by ``keys``
    ascending among gainers and descending among losers, so the loser rank of a
    ranked row is the mirror image of its gainer rank.
    """
    keys = list(keys)
    pairs = F.array(
        *[F.struct(F.lit(label).alias("label"), F.col(c).alias("value")) for label, c in measures.items()]
    )
    long = df.select(*keys, F.explode(pairs).alias("_pair")).select(
        *keys, F.col("_pair.label").alias("_label"), F.col("_pair.value").alias("_value")
    )
    known = long.groupBy("_label").agg(F.count("_value").alias("_known"))
    ordered = running_total(
        long, ["_label"], [F.col("_value").desc_nulls_last(), *[F.col(k).asc() for k in keys]]
    )
    # One row per label named in the call; a shuffle by label would make few, huge partitions.
    ordered = ordered.join(F.broadcast(known), "_label")
    gainer = (F.col("_before") + 1).cast("bigint")
    ranked = ordered.select(
        *keys,
        "_label",
        gainer.alias("_gainer"),
        F.when(F.col("_value").isNull(), gainer)
        .otherwise((F.col("_known") - F.col("_before")).cast("bigint"))
        .alias("_loser"),
    )
    columns = []
    for label in measures:
        mine = F.col("_label") == label
        columns += [
            F.max(F.when(mine, F.col("_gainer"))).alias(f"rank_{label}_gainer"),
            F.max(F.when(mine, F.col("_loser"))).alias(f"rank_{label}_loser"),
        ]
    return ranked.groupBy(*keys).agg(*columns)


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
    *,
    suffix: str = "_quantiles",
) -> DataFrame:
    """Exact interpolated quantiles per group as arrays, NULL values excluded.

    Values are selected by position over a distributed ordering of distinct
    values, so a group of any size spreads over many tasks and every group is
    computed in the same way. (Where groups are known to be small, the built-in
    ``percentile`` can share a ``groupBy`` with other aggregates.)
    """
    groups = list(groups)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    counted = (
        df.select(*groups, F.explode(pairs).alias("_pair"))
        .select(*groups, F.col("_pair.name").alias("_name"), F.col("_pair.value").alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*groups, "_name", "_value")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    placed = running_total(counted, [*groups, "_name"], [F.col("_value").asc()], "_copies")
    after = F.col("_before") + F.col("_copies")
    picks = []
    for i, p in enumerate(probabilities):
        target = F.lit(float(p)) * (F.col("_total") - 1)
        picks += [
            F.min(F.when(after > F.floor(target), F.col("_value"))).alias(f"_low{i}"),
            F.min(F.when(after > F.ceil(target), F.col("_value"))).alias(f"_high{i}"),
        ]
    chosen = placed.groupBy(*groups, "_name").agg(F.max("_total").alias("_total"), *picks)
    points = []
    for i, p in enumerate(probabilities):
        target = F.lit(float(p)) * (F.col("_total") - 1)
        share = target - F.floor(target)
        points.append(F.col(f"_low{i}") + share * (F.col(f"_high{i}") - F.col(f"_low{i}")))
    chosen = chosen.withColumn("_points", F.array(*points))
    by_name = chosen.groupBy(*groups).agg(
        *[F.max(F.when(F.col("_name") == c, F.col("_points"))).alias(c + suffix) for c in columns]
    )
    # Groups whose columns are all NULL have no ordered rows but still exist.
    return df.select(*groups).distinct().join(by_name, groups, "left")
