"""Unions of differently shaped inputs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_padded(sources: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """All sources stacked by column name with typed NULLs where one lacks a column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_at_cutover(history: DataFrame, recent: DataFrame, ts: str, cutoff: Any) -> DataFrame:
    """History strictly before the cutoff, recent rows from it on."""
    point = F.lit(cutoff).cast("timestamp_ntz")
    return history.where(F.col(ts) < point).unionByName(
        recent.where(F.col(ts) >= point), allowMissingColumns=False
    )
