"""Grouped aggregates that need more than one built-in function."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import field_list


def sum_when(condition: Column, amount: Column) -> Column:
    return F.sum(F.when(condition, amount))


def max_when(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-null value per key; ties take the smallest value.

    Counts per (key, value) first, so a heavy key costs one partial count per
    value and task instead of a per-key map of all its values in one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("_rank"), F.col(value))).alias("_best")
    )
    return best.select(*keys, F.col("_best")[value].alias(value))


def distinct_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct non-null values per key as an array (pairs are deduplicated first)."""
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))


def first_distinct_values(
    df: DataFrame, keys: Sequence[str], value: str, name: str, size: int
) -> DataFrame:
    """The ``size`` smallest distinct values per key as an array.

    A bounded row number drops the surplus on both sides of the shuffle before
    anything is collected.
    """
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    numbered = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(value)))
    return (
        numbered.where(F.col("_n") <= size)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(value)).alias(name))
    )


def legs_to_arrays(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    kinds: Mapping[str, str],
    order: Sequence[str],
    fields: Mapping[str, str],
) -> DataFrame:
    """Child rows of each parent as parallel arrays, one set of arrays per kind.

    ``kinds`` maps an output prefix to a kind value and ``fields`` an output
    suffix to a column, giving ``<prefix>_<suffix>``. The children are collected
    and sorted once; each kind then filters that one array, instead of
    collecting the group once per kind.
    """
    wanted = df.where(F.col(kind).isin(*kinds.values()))
    legs = F.collect_list(leg_entry(F.col, kind, order, list(fields.values())))
    grouped = wanted.groupBy(*keys).agg(legs.alias("_legs"))
    return grouped.select(*keys, *leg_arrays(F.col("_legs"), kinds, list(fields)))


def leg_entry(field: Callable[[str], Column], kind: str, order: Sequence[str], values: Sequence[str]) -> Column:
    """A child row as ``leg_arrays`` reads it: what it is sorted by, its kind, its values."""
    return F.struct(
        *[field(c).alias(f"_o{i}") for i, c in enumerate(order)],
        field(kind).alias("_kind"),
        *[field(c).alias(f"_f{i}") for i, c in enumerate(values)],
    )


def leg_arrays(legs: Column, kinds: Mapping[str, str], suffixes: Sequence[str]) -> list[Column]:
    """Parallel arrays ``<prefix>_<suffix>`` per kind out of one array of ``leg_entry``."""
    columns = []
    ordered = F.sort_array(legs)
    for prefix, value in kinds.items():
        mine = F.filter(ordered, _is_kind(value))
        for i, suffix in enumerate(suffixes):
            columns.append(field_list(mine, f"_f{i}").alias(f"{prefix}_{suffix}"))
    return columns


def _is_kind(value: str) -> Callable[[Column], Column]:
    return lambda leg: leg["_kind"] == value


def json_objects(df: DataFrame, keys: Sequence[str], fields: Mapping[str, Column], name: str) -> DataFrame:
    """Rows of each key as one JSON array text, ordered by the fields."""
    entry = F.struct(*[value.alias(field) for field, value in fields.items()])
    rows = F.sort_array(F.collect_list(entry))
    options = {"ignoreNullFields": "false"}
    return df.groupBy(*keys).agg(F.to_json(rows, options).alias(name))
