"""Time-bucketed aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import hour_of
from ledgerlens.operators.merge import last_value


def hourly_last(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Mapping[str, str],
    tie_break: Sequence[str] = (),
    unique_ts: bool = False,
    combine: bool = True,
) -> DataFrame:
    """Last non-null value of each column per key and hour.

    ``values`` maps output names to input columns. Equal times take the greatest
    ``tie_break``, then the greatest value. ``unique_ts`` says that (key, time)
    never repeats with different values: ordering by time alone has a
    fixed-width buffer, so numeric columns stay in hash aggregation. ``combine=False``
    moves the rows before it aggregates: without it a map task sorts all its rows by
    key to combine them, which pays only if a key has many rows in an hour.
    """
    out = []
    for name, source in values.items():
        order = F.col(ts) if unique_ts else F.struct(ts, *tie_break, source)
        out.append(last_value(F.col(source), order).alias(name))
    rows = df.withColumn("date_hour", hour_of(F.col(ts)))
    rows = rows if combine else rows.repartition(*keys, "date_hour")
    return rows.groupBy(*keys, "date_hour").agg(*out)


def latest_per_entity(
    df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]
) -> DataFrame:
    """Newest non-null value of every column per entity (columns may come from different rows)."""
    return df.groupBy(*keys).agg(*[last_value(F.col(c), F.col(ts)).alias(c) for c in values])


def daily_totals(sources: Mapping[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """One row per day with one summed measure per source, zero where a source has no rows.

    ``sources`` maps a measure to (rows, timestamp column, amount). Every source
    is summed per day before the union, so only daily rows are shuffled twice.
    """
    branches = None
    for measure, (rows, ts, amount) in sources.items():
        branch = rows.groupBy(F.to_date(ts).alias("date_day")).agg(F.sum(amount).alias(measure))
        branches = (
            branch if branches is None else branches.unionByName(branch, allowMissingColumns=True)
        )
    return branches.groupBy("date_day").agg(
        *[F.coalesce(F.sum(measure), F.lit(0)).alias(measure) for measure in sources]
    )
