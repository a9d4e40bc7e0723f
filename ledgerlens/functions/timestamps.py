"""UTC time buckets and timestamp clean-up.

Plans keep time as ``timestamp_ntz`` holding UTC wall-clock values, so results
do not move with the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAIVE = "timestamp_ntz"


def naive(value: Column) -> Column:
    return value.cast(NAIVE)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast(NAIVE)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def epoch_to_null(ts: Column) -> Column:
    """The epoch is a sentinel for 'no value' in raw feeds."""
    return F.nullif(ts.cast(NAIVE), F.lit("1970-01-01 00:00:00").cast(NAIVE))


def unix_timestamp_or_null(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("bigint")).cast(NAIVE)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text (``Z`` or an offset; no zone means UTC) as a UTC timestamp."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit(""))).cast(NAIVE)
