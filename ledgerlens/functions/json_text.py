"""Reading and writing JSON kept in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_string_list(value: Column) -> Column:
    """JSON array text to ``array<string>``; missing or malformed text gives an empty array."""
    parsed = F.from_json(value, "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def json_field(value: Column, key: str) -> Column:
    return F.get_json_object(value, f"$.{key}")


def json_text(value: Column) -> Column:
    return F.to_json(value)
