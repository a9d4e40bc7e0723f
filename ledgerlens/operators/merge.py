"""Read-time merges: newest row per key, and newest value per column and key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ordering(version: Sequence[str]) -> Column:
    return F.col(version[0]) if len(version) == 1 else F.struct(*version)


def last_value(value: Column, order: Column) -> Column:
    """Value at the greatest ``order``, skipping rows whose value is NULL."""
    return F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), order))


def dedup_latest(
    df: DataFrame, keys: Sequence[str], version: Sequence[str], combine: bool = True
) -> DataFrame:
    """One row per key: the one with the greatest ``version`` columns.

    Remaining columns break ties, so the answer does not depend on row order.
    Whole rows travel as one struct under ``max``, which combines on the map
    side: a key with very many versions sends one row per input partition. A map
    task sorts all its rows for that; where keys have few versions, ``combine=False``
    moves the rows first and sorts them once, in pieces of a shuffle partition.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    df = df if combine else df.repartition(*keys)
    newest = df.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("_row"))
    return newest.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def coalesce_merge(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    version: Sequence[str] | None = None,
    together: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Fold rows of one key into one: the last non-null value of every column.

    Empty arrays count as missing while folding and come back as empty arrays.
    Without ``version`` each column must have at most one value per key (as in
    a union of sources that own disjoint columns). If all values of a key in some
    columns come from one row, as with the columns of one source, ``together`` may
    name them: they travel as one struct, so a sparse row is as wide as what it holds.
    """
    types = dict(df.dtypes)
    if together:
        return _fold_packed(df, keys, values, together)
    order = _ordering(version) if version else None
    folded = []
    for name in values:
        value = F.col(name)
        is_array = types[name].startswith("array")
        if is_array:
            value = F.when(F.size(value) > 0, value)
        result = last_value(value, order) if order is not None else F.max(value)
        if is_array:
            result = F.coalesce(result, F.array().cast(types[name]))
        folded.append(result.alias(name))
    return df.groupBy(*keys).agg(*folded)


def _fold_packed(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], together: Sequence[Sequence[str]]
) -> DataFrame:
    types = dict(df.dtypes)
    packs = [list(pack) for pack in together]
    packs += [[c] for c in values if not any(c in pack for pack in packs)]
    held = {c: F.when(F.size(c) > 0, F.col(c)) if types[c].startswith("array") else F.col(c) for c in values}
    packed = df.select(
        *keys,
        *[
            F.when(
                reduce(Column.__or__, [held[c].isNotNull() for c in pack]),
                F.struct(*[held[c].alias(c) for c in pack]),
            ).alias(f"_pack{i}")
            for i, pack in enumerate(packs)
        ],
    )
    folded = packed.groupBy(*keys).agg(*[F.max(f"_pack{i}").alias(f"_pack{i}") for i in range(len(packs))])
    place = {c: F.col(f"_pack{i}")[c] for i, pack in enumerate(packs) for c in pack}
    return folded.select(
        *keys,
        *[
            (F.coalesce(place[c], F.array().cast(types[c])) if types[c].startswith("array") else place[c]).alias(c)
            for c in values
        ],
    )


def latest_load(
    df: DataFrame,
    loads: DataFrame,
    keys: dict[str, Column],
    load_id: str = "_load_id",
) -> DataFrame:
    """Rows of the newest load that touched each business key.

    ``keys`` maps names to key expressions over ``df``; ``loads`` holds
    ``load_id`` and ``inserted_at``. Rows with an unlogged load are dropped.
    """
    named = df.select("*", *[expr.alias(f"_key_{name}") for name, expr in keys.items()])
    key_names = [f"_key_{name}" for name in keys]
    stamped = named.join(
        loads.select(F.col("load_id").alias(load_id), F.col("inserted_at").alias("_inserted_at")),
        load_id,
    )
    newest = stamped.groupBy(*key_names).agg(
        F.max(F.struct("_inserted_at", load_id)).alias("_newest")
    )
    newest = newest.select(*key_names, F.col("_newest")[load_id].alias(load_id))
    return named.join(newest, [*key_names, load_id], "left_semi").select(*df.columns)
