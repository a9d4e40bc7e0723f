"""Defaults, safe casts and small conditional rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.decimals import AMOUNT


def default_text(value: Column, default: str = "Unknown") -> Column:
    return F.coalesce(value, F.lit(default))


def if_blank(value: Column, default: Column) -> Column:
    """``default`` where the text is NULL, empty or the word null."""
    return F.when(value.isNull() | value.isin("", "null"), default).otherwise(value)


def safe_bigint(value: Column) -> Column:
    return F.trim(value).try_cast("bigint")


def bool_or(value: Column, default: bool = False) -> Column:
    return F.coalesce(value.cast("boolean"), F.lit(default))


def signed_by_action(action: Column, amount: Column) -> Column:
    """Deposits count up, withdrawals count down, anything else is neutral."""
    kind = F.lower(action)
    return (
        F.when(kind == "deposit", amount)
        .when(kind == "withdrawal", -amount)
        .otherwise(F.lit(0).cast(AMOUNT))
    )


def flow_direction(action: Column) -> Column:
    kind = F.lower(action)
    return (
        F.when(kind == "deposit", F.lit("inflow"))
        .when(kind == "withdrawal", F.lit("outflow"))
        .otherwise(F.lit("other"))
    )
