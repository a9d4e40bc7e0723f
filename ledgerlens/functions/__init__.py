"""Column functions shared by the plans (all JVM-side, no Python UDFs)."""

from ledgerlens.functions.addresses import (
    NATIVE_ADDRESS,
    address_list,
    hex_text,
    lower_hash,
    network_key,
    representation_address,
)
from ledgerlens.functions.arrays import (
    decimal_list,
    distinct_flat,
    field_list,
    join_text,
    split_part,
    typed_empty_array,
)
from ledgerlens.functions.decimals import (
    AMOUNT,
    decimal_or_zero,
    price_overflow,
    scaled_integer,
    to_decimal,
    usd_below,
    usd_value,
    whole_coins,
)
from ledgerlens.functions.json_text import json_field, json_string_list, json_text
from ledgerlens.functions.timestamps import (
    day_of,
    epoch_to_null,
    hour_of,
    iso_timestamp,
    month_of,
    naive,
    unix_timestamp_or_null,
)
from ledgerlens.functions.values import (
    bool_or,
    default_text,
    flow_direction,
    if_blank,
    safe_bigint,
    signed_by_action,
)
from ledgerlens.functions.wide import overflow_reason, wide_product, wide_usd

__all__ = [name for name in dir() if not name.startswith("_")]
