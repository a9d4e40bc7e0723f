"""Fixed-point money arithmetic inside Spark's 38 digits.

Amounts and prices are stored as DECIMAL(38,18). The type of a product keeps
18 decimals only if the factors have at most 19 whole digits between them, so
``usd_value`` narrows the factors before multiplying.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = T.DecimalType(38, 18)

# Types of (amount, price) with 18 decimals each and 12+7, 14+5, 16+3 and 9+10
# whole digits. Every product type is DECIMAL(38,18), rounded from the exact
# product.
_FACTORS = (
    ("decimal(30,18)", "decimal(25,18)"),
    ("decimal(32,18)", "decimal(23,18)"),
    ("decimal(34,18)", "decimal(21,18)"),
    ("decimal(27,18)", "decimal(28,18)"),
)


def to_decimal(value: Column) -> Column:
    """Number or numeric text as DECIMAL(38,18); unreadable or too large gives NULL."""
    return value.try_cast(AMOUNT)


def decimal_or_zero(value: Column) -> Column:
    return F.coalesce(to_decimal(value), F.lit(0).cast(AMOUNT))


def usd_value(amount: Column, price: Column) -> Column:
    """``amount * price`` as DECIMAL(38,18): the exact product rounded to 18 decimals.

    Factors with more whole digits than any of the four splits holds give NULL;
    ``price_overflow`` finds those rows.
    """
    return F.coalesce(
        *[amount.try_cast(left) * price.try_cast(right) for left, right in _FACTORS]
    )


def usd_below(amount: Column, price: Column, limit: int) -> Column:
    """``amount * price < limit``, compared in millionths; a product too large to hold is not below."""
    return F.coalesce(F.try_multiply(amount, price) < F.lit(limit), F.lit(False))


def price_overflow(amount: Column, price: Column) -> Column:
    """True where both inputs are present but their USD value is not representable."""
    return amount.isNotNull() & price.isNotNull() & usd_value(amount, price).isNull()


def scaled_integer(value: Column, digits: int) -> Column:
    """Integer text in the smallest unit as a decimal with ``digits`` decimals."""
    return F.coalesce(value.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")) / F.lit(
        10**digits
    ).cast("decimal(38,0)")


def whole_coins(units: Column) -> Column:
    """Integer amount in units of 1e-18 coin as whole coins, exact to the last unit."""
    unit = F.lit("0.000000000000000001").cast("decimal(18,18)")
    few = units.try_cast("decimal(19,0)") * unit
    many = units.try_cast("decimal(38,0)")
    coin = F.lit(10**18).cast("decimal(19,0)")
    rest = many % coin
    coins = ((many - rest) / coin).try_cast("decimal(37,18)")
    exact = coins + (rest.cast("decimal(19,0)") * unit).cast("decimal(37,18)")
    return F.coalesce(few, exact.cast(AMOUNT))
