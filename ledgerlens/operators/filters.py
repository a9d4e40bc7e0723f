"""Row filters built from data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_bounds(bounds: Mapping[str, tuple[Any, Any]]) -> Column:
    """All columns inside their inclusive range; a NULL column fails the row."""
    return reduce(
        lambda a, b: a & b,
        [F.col(name).between(F.lit(low), F.lit(high)) for name, (low, high) in bounds.items()],
    )


def drop_listed(df: DataFrame, listed: Iterable[Sequence[Any]], columns: Sequence[str]) -> DataFrame:
    """Rows whose column tuple is not on a fixed list written in code."""
    spark = df.sparkSession
    schema = ", ".join(f"`_d{i}` {dict(df.dtypes)[c]}" for i, c in enumerate(columns))
    denied = spark.createDataFrame([tuple(row) for row in listed], schema)
    condition = reduce(
        lambda a, b: a & b, [df[c] == denied[f"_d{i}"] for i, c in enumerate(columns)]
    )
    # The list is part of the source code, so its size is fixed.
    return df.join(F.broadcast(denied), condition, "left_anti")


def scoped_exclusion(
    entity: Column, key: Any, ts: Column, start: str, end: str, value: Column, above: Any
) -> Column:
    """True for rows of one entity, inside a period, above a value (rows to drop)."""
    hit = (
        (entity == F.lit(key))
        & ts.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
        & (value > F.lit(above))
    )
    return F.coalesce(hit, F.lit(False))


def since(ts: Column, as_of: Any, days: int) -> Column:
    """At most ``days`` days before ``as_of``."""
    return ts >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL '{int(days)}' DAY")


def not_in_future(ts: Column, as_of: Any, days: int = 1) -> Column:
    """Before ``as_of`` plus ``days`` days."""
    return ts < F.lit(as_of).cast("timestamp_ntz") + F.expr(f"INTERVAL '{int(days)}' DAY")


def after_epoch(ts: Column) -> Column:
    return ts.isNotNull() & (F.to_date(ts) > F.lit("1970-01-01").cast("date"))


def unlike_stored(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored, or stored with other values. NULLs compare as equal."""
    values = [c for c in rows.columns if c not in keys]
    old = stored.select(*[F.col(c).alias(f"_old_{c}") for c in keys], F.struct(*values).alias("_old"))
    mine = rows.withColumn("_new", F.struct(*values))
    same = [mine[c].eqNullSafe(old[f"_old_{c}"]) for c in keys] + [mine["_new"].eqNullSafe(old["_old"])]
    return mine.join(old, reduce(Column.__and__, same), "left_anti").drop("_new")
