"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.decimals import to_decimal


def decimal_list(values: Column) -> Column:
    return F.transform(values, to_decimal)


def distinct_flat(nested: Column) -> Column:
    """Distinct non-null elements of an array of arrays, in sorted order."""
    flat = F.filter(F.flatten(nested), lambda item: item.isNotNull())
    return F.sort_array(F.array_distinct(flat))


def field_list(rows: Column, name: str) -> Column:
    """One field of an array of structs as an array of its own."""
    return F.transform(rows, lambda row: row[name])


def join_text(values: Column, separator: str = ",") -> Column:
    return F.array_join(values, separator)


def split_part(value: Column, separator: str, position: int) -> Column:
    """Zero-based part of a separated text, NULL when there is no such part."""
    return F.get(F.split(value, separator), F.lit(position))


def typed_empty_array(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")
