"""Address, hash and network-key text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder address of a chain's native coin, and the texts
# that stand for "native coin" in raw data.
NATIVE_ADDRESS = "0x0000000000000000000000000000000000000000"
NATIVE_TEXTS = ("native", "null", "")


def lower_hash(value: Column) -> Column:
    return F.lower(value)


def hex_text(value: Column) -> Column:
    """Binary column as ``0x``-prefixed lowercase hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(value)))


def network_key(value: Column) -> Column:
    """Trimmed, lowercased chain key with the one renamed chain mapped."""
    return F.replace(F.lower(F.trim(value)), F.lit("harmony"), F.lit("one"))


def representation_address(value: Column) -> Column:
    """Lowercased address; missing or native-coin texts become the native address."""
    blank = value.isNull() | F.trim(F.lower(value)).isin(*NATIVE_TEXTS)
    return F.when(blank, F.lit(NATIVE_ADDRESS)).otherwise(F.lower(value))


def address_list(values: Column) -> Column:
    return F.transform(values, representation_address)
