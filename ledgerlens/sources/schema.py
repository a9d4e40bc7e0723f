"""Declared column types applied to loosely typed raw rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_hints(df: DataFrame, hints: Mapping[str, str], keep_raw: bool = False) -> DataFrame:
    """Cast hinted columns, leaving the others as read.

    Unreadable values become NULL. ``keep_raw`` adds ``<column>__raw`` holding
    the original text of exactly those values, so nothing is lost silently.
    """
    columns = []
    for name in df.columns:
        if name not in hints:
            columns.append(F.col(name))
            continue
        cast = F.col(name).try_cast(hints[name])
        columns.append(cast.alias(name))
        if keep_raw:
            bad = F.col(name).isNotNull() & cast.isNull()
            columns.append(F.when(bad, F.col(name).cast("string")).alias(f"{name}__raw"))
    missing = [F.lit(None).cast(t).alias(n) for n, t in hints.items() if n not in df.columns]
    return df.select(*columns, *missing)


def struct_of(fields: Mapping[str, str], required: Iterable[str] = ()) -> T.StructType:
    """``StructType`` from name -> type text, with the required fields non-nullable."""
    needed = set(required)
    return T.StructType(
        [
            T.StructField(name, T.DataType.fromDDL(kind), name not in needed)
            for name, kind in fields.items()
        ]
    )


def camel_to_snake(name: str) -> str:
    out = []
    for i, letter in enumerate(name):
        if letter.isupper() and i and not name[i - 1].isupper():
            out.append("_")
        out.append(letter.lower())
    return "".join(out)


def snake_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(camel_to_snake(c)) for c in df.columns])
