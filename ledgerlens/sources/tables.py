"""Relational and file tables as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import hex_text


@dataclass(frozen=True)
class FileTable:
    """A table kept as files (parquet by default), with the schema of the files unless one is given."""

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return (reader if self.schema is None else reader.schema(self.schema)).load(self.path)


@dataclass(frozen=True)
class JdbcTable:
    """A database table read in parallel ranges of a numeric or time column."""

    url: str
    table: str
    partition_column: str | None = None
    lower: str | None = None
    upper: str | None = None
    partitions: int = 32
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        reader = (
            spark.read.format("jdbc")
            .options(**self.options)
            .option("url", self.url)
            .option("dbtable", self.table)
            .option("fetchsize", "100000")
        )
        if self.partition_column:
            reader = (
                reader.option("partitionColumn", self.partition_column)
                .option("lowerBound", self.lower)
                .option("upperBound", self.upper)
                .option("numPartitions", str(self.partitions))
            )
        return reader.load()


def read_window(
    table: DataFrame,
    ts: str,
    start: datetime,
    days: int = 120,
    keys: tuple[str, Iterable] | DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Rows with ``start < ts <= start + days``, limited to known keys.

    Both bounds are literals, so they reach the file or database reader. Keys
    are either a short list ``(column, values)`` or a DataFrame with ``key``.
    """
    low = F.lit(str(start)).cast("timestamp_ntz")
    high = F.lit(str(start + timedelta(days=days))).cast("timestamp_ntz")
    rows = table.where((F.col(ts) > low) & (F.col(ts) <= high))
    if isinstance(keys, tuple):
        return rows.where(F.col(keys[0]).isin(*keys[1]))
    if keys is not None:
        return rows.join(keys.select(key).distinct(), key, "left_semi")
    return rows


def read_optional(spark: SparkSession, table: FileTable | JdbcTable) -> DataFrame | None:
    """The table, or None when it does not exist (the caller keeps its old state)."""
    try:
        return table.read(spark)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet rows below ``path``; none if nothing was written there yet."""
    found = read_optional(spark, FileTable(path, schema=schema))
    return spark.createDataFrame([], schema) if found is None else found


def bytes_to_hex(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Binary columns as ``0x`` text, others untouched."""
    return df.withColumns({c: hex_text(F.col(c)) for c in columns})


def feed_since(df: DataFrame, ts: str, cursor: datetime | None) -> DataFrame:
    """Feed rows at or after the cursor; boundary rows repeat and are merged by key later."""
    if cursor is None:
        return df
    return df.where(F.col(ts) >= F.lit(str(cursor)).cast("timestamp_ntz"))
