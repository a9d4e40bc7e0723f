"""Structured Streaming versions of the micro-batch rules.

Every job runs with ``availableNow``: it processes what has landed, keeps its
progress in the checkpoint folder, and stops, so a scheduler can call it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.sinks.upsert import upsert


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    name_filter: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, late: str = "1 day") -> DataFrame:
    """At-least-once input to one row per key; state is dropped once the watermark passes."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def hourly_last_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, value: str, late: str = "1 day"
) -> DataFrame:
    """Current last non-null value per key and hour, updated as rows arrive.

    ``ts`` must be a timestamp with zone. Equal times take the greatest value.
    """
    known = F.col(value).isNotNull()
    newest = F.max(F.when(known, F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))))
    return (
        stream.withWatermark(ts, late)
        .groupBy(*keys, F.window(ts, "1 hour").alias("_hour"))
        .agg(newest.alias("_newest"))
        .select(
            *keys,
            F.col("_hour.start").cast("timestamp_ntz").alias("date_hour"),
            F.col("_newest.v").alias(value),
        )
    )


def run_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    *,
    partition_by: str | None = None,
    version: Sequence[str] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Merges each micro-batch into the table at ``path``; rerunning a batch changes nothing.

    With ``version`` the newest row per key wins over batch and table together,
    so an older row that arrives later changes nothing.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert(batch, path, keys, partition_by=partition_by, version=version)

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def run_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends finished rows to a parquet folder exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def with_day(df: DataFrame, ts: str, name: str = "day") -> DataFrame:
    """Partition column for upserts keyed by a time in that day."""
    return df.withColumn(name, F.to_date(ts))
