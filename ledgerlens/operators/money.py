"""USD values of rows, the rows whose value exceeds 38 digits, and totals that count both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.decimals import AMOUNT, usd_value
from ledgerlens.functions.wide import VALUE_LIMBS, overflow_reason, wide_limbs, wide_text, wide_usd, wide_usd_limbs


def quarantine(df: DataFrame, keys: Sequence[str], amount: str, price: str) -> DataFrame:
    """The rows whose amount and price are present but have no USD value of 38 digits.

    Columns: the keys, both factors as text, ``reason`` and ``usd_wide``, the exact value rounded
    to 18 decimals (NULL where a factor is unreadable or has more than 56 whole digits).
    """
    a, p = F.col(amount), F.col(price)
    return df.select(
        *keys,
        a.cast("string").alias(amount),
        p.cast("string").alias(price),
        overflow_reason(a, p).alias("reason"),
        wide_usd(a, p).alias("usd_wide"),
    ).where(F.col("reason").isNotNull())


def usd_totals(df: DataFrame, keys: Sequence[str], amount: str, price: str) -> DataFrame:
    """Exact sums of USD values per key tuple, with the values that need more than 38 digits.

    Columns: the keys, ``usd_total`` (text with 18 decimals; NULL if no row has a value),
    ``usd`` (the same as DECIMAL(38,18), NULL if it does not fit), ``n_wide`` and ``n_unreadable``.
    Values of 38 digits are summed in two parts, whole coins and fractions, wide ones by limbs;
    all sums combine before the shuffle and hold 10**20 rows.
    """
    a, p = F.col(amount), F.col(price)
    small = usd_value(a.try_cast(AMOUNT), p.try_cast(AMOUNT))
    rows = df.select(
        *keys, small.alias("_small"), wide_usd_limbs(a, p).alias("_limbs"), (a.isNotNull() & p.isNotNull()).alias("_present")
    )
    value = F.col("_small")
    fraction = value % F.lit(1).cast(AMOUNT)
    sums = rows.groupBy(*keys).agg(
        F.sum((value - fraction).cast("decimal(28,0)")).alias("_whole"),
        F.sum(fraction.cast("decimal(28,18)")).alias("_fraction"),
        *[F.sum(F.col("_limbs")[i].cast("decimal(28,0)")).alias(f"_limb_{i}") for i in range(VALUE_LIMBS)],
        F.count("_limbs").alias("n_wide"),
        F.count_if(F.col("_present") & value.isNull() & F.col("_limbs").isNull()).alias("n_unreadable"),
    )
    none = F.col("_whole").isNull() & (F.col("n_wide") == 0)
    total = F.when(~none, wide_text(_added(["_whole", "_fraction"]))).alias("usd_total")
    return sums.select(*keys, total, "n_wide", "n_unreadable").select(
        *keys, "usd_total", F.col("usd_total").try_cast(AMOUNT).alias("usd"), "n_wide", "n_unreadable"
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores where the source has few pieces; for narrow rows, before they are valued.

    A row takes far longer to value than to move, and a file is read by no more tasks than it has row groups.
    """
    wanted = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted // 2 else rows


def _added(parts: Sequence[str]) -> Column:
    """Limb sums plus the limbs of decimal columns; absent parts are zero."""
    zero = F.lit(0).cast("decimal(38,0)")
    limbs = F.array(*[F.coalesce(F.col(f"_limb_{i}"), zero) for i in range(VALUE_LIMBS)])
    for part in parts:
        own = wide_limbs(F.coalesce(F.col(part), F.lit(0).cast("decimal(1,0)")))
        limbs = F.zip_with(limbs, own, lambda x, y: (x + y).cast("decimal(38,0)"))
    return limbs
