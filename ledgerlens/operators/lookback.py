"""Values of the same entity at fixed distances before a reference hour."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_lookback(
    history: DataFrame,
    keys: Sequence[str],
    hour: str,
    value: str,
    as_of: datetime,
    periods: Mapping[str, int],
) -> DataFrame:
    """``<value>_<label>_ago`` per key: the value exactly ``days`` days before the as-of hour.

    One scan limited to the wanted hours (which reaches the file reader as an
    IN filter) and one aggregate, instead of one join per period.
    """
    anchor = as_of.replace(minute=0, second=0, microsecond=0)
    hours = {label: anchor - timedelta(days=days) for label, days in periods.items()}
    literals = {label: F.lit(str(at)).cast("timestamp_ntz") for label, at in hours.items()}
    return (
        history.where(F.col(hour).isin(*literals.values()))
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col(hour) == at, F.col(value))).alias(f"{value}_{label}_ago")
                for label, at in literals.items()
            ]
        )
    )
