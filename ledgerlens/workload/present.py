"""One presentation of results for both engines, so that values can be compared.

A column is written ``name`` or ``name:kind``. Kinds: ``d`` number rounded to six
decimals, ``t`` timestamp, ``s`` text list, ``n`` number list (``q`` with six decimals), ``i`` integer, ``x`` text. Lists
become comma-separated text and dates become midnight timestamps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Decimals shown per number-list kind.
_FIXED = {"n": 4, "q": 6}


def _spark(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "d":
        return F.round(column.cast("double"), 6)
    if kind == "t":
        return column.cast("timestamp_ntz")
    if kind == "s":
        return F.coalesce(F.array_join(column.cast("array<string>"), ","), F.lit(""))
    if kind in _FIXED:
        digits = f"decimal(38,{_FIXED[kind]})"
        fixed = F.transform(column, lambda x: x.cast(digits).cast("string"))
        return F.coalesce(F.array_join(fixed, ","), F.lit(""))
    if kind == "i":
        return column.cast("bigint")
    if kind == "x":
        return column.cast("string")
    return column


def _duckdb(name: str, kind: str) -> str:
    if kind == "d":
        return f"round(CAST({name} AS DOUBLE), 6)"
    if kind == "t":
        return f"CAST({name} AS TIMESTAMP)"
    if kind == "s":
        return f"coalesce(array_to_string(CAST({name} AS VARCHAR[]), ','), '')"
    if kind in _FIXED:
        return (
            f"coalesce(array_to_string([CAST(CAST(x AS DECIMAL(38,{_FIXED[kind]})) AS VARCHAR) FOR x IN {name}], ','), '')"
        )
    if kind == "i":
        return f"CAST({name} AS BIGINT)"
    if kind == "x":
        return f"CAST({name} AS VARCHAR)"
    return name


def _parsed(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(c.split(":")[0], c.partition(":")[2]) for c in columns]


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[_spark(name, kind).alias(name) for name, kind in _parsed(columns)])


def select_sql(source: str, columns: Sequence[str]) -> str:
    """``SELECT`` of the same presentation; ``source`` is a table name or a SELECT."""
    inner = source if " " not in source.strip() else f"({source})"
    body = ", ".join(f"{_duckdb(name, kind)} AS {name}" for name, kind in _parsed(columns))
    return f"SELECT {body} FROM {inner} AS src"
