"""Streams whose late and repeated rows are told against all that is stored, not against a watermark.

Each micro-batch is written below ``batch=<id>``, partitioned by the day of its
rows; a batch that is run again overwrites its own folder, so the tables hold every
batch once. What came before a batch is what batches with smaller ids wrote, also
when it is run again.

Nothing is dropped for being late. A row is late if it is older than the newest row
of all earlier batches by more than the allowed lateness; late rows are kept,
marked, and counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.merge import dedup_latest
from ledgerlens.session import ROWS_PER_FILE, materialize
from ledgerlens.sinks.upsert import upsert
from ledgerlens.sinks.versions import read_version
from ledgerlens.sources.tables import FileTable, read_if_there, read_optional

DAY, BATCH, LATE = "_day", "batch", "late"


def _batch_folder(path: str, batch: int) -> str:
    return f"{path}/{BATCH}={batch}"


def _clock(batch: DataFrame, batch_id: int, path: str, ts: str) -> None:
    """Notes the newest time of a batch: one row per batch."""
    newest = batch.agg(F.max(ts).cast("timestamp_ntz").alias("newest"), F.count("*").alias("rows"))
    newest.write.mode("overwrite").parquet(_batch_folder(f"{path}-clock", batch_id))


def _marked(batch: DataFrame, batch_id: int, path: str, ts: str, late: str) -> DataFrame:
    """``batch`` with ``late``, judged by the clock of the batches before."""
    clock = read_if_there(batch.sparkSession, f"{path}-clock", "newest timestamp_ntz, rows long, batch long")
    newest = clock.where(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
    if newest is None:
        return batch.withColumn(LATE, F.lit(False))
    edge = F.lit(str(newest)).cast("timestamp_ntz") - F.expr(f"interval {late}")
    return batch.withColumn(LATE, F.coalesce(F.col(ts).cast("timestamp_ntz") < edge, F.lit(False)))


def unseen(batch: DataFrame, history: DataFrame | None, keys: Sequence[str], day: str | None = DAY) -> DataFrame:
    """Rows of ``batch`` whose key ``history`` does not hold, whatever its age.

    With ``day`` (a partition column of the history that a repeated row shares with
    its first delivery) only the days in the batch are read. The keys' range in the
    batch goes to the scan as literals, so row groups outside it are skipped; and as
    an equi-join on the keys, a large history is open to the Bloom filter that Spark
    builds from the smaller side before the shuffle.
    """
    if history is None:
        return batch
    spans = batch.agg(*[f(k).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max))]).first()
    held = history
    for k in keys:
        low, high = spans[f"low_{k}"], spans[f"high_{k}"]
        if low is not None:
            kind = batch.schema[k].dataType
            held = held.where(F.col(k).isNull() | F.col(k).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    if day:
        days = [r[0] for r in batch.select(day).distinct().collect()]  # as many as a batch has days
        held = held.where(F.col(day).isin([d for d in days if d is not None]) | F.col(day).isNull())
    held = held.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [batch[k].eqNullSafe(held[f"_seen_{k}"]) for k in keys]
    return batch.join(held, reduce(Column.__and__, same), "left_anti")


def _day(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def run_dedup(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    late: str = "1 day",
    same_day: bool = True,
) -> StreamingQuery:
    """Stores the first delivery of each key below ``path``, with ``late``.

    Repeats are told however old they are. ``same_day`` says that a repeated row has
    the time of its first delivery; else all days are searched. Of several rows of a
    key in one batch the one with the greatest columns stays.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = materialize(_marked(batch, batch_id, path, ts, late).withColumn(DAY, _day(ts)), "stream-batch")
        _clock(rows, batch_id, path, ts)
        schema = T.StructType([*rows.schema.fields, T.StructField(BATCH, T.LongType())])
        history = read_optional(spark, FileTable(path, schema=schema))
        if history is not None:
            history = history.where(F.col(BATCH) < batch_id)
        fresh = unseen(dedup_latest(rows, list(keys), [ts]), history, keys, DAY if same_day else None)
        writer = fresh.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
        writer.partitionBy(DAY).parquet(_batch_folder(path, batch_id))

    return _started(stream, checkpoint, store, "append")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``run_dedup`` stored, late ones marked."""
    return spark.read.parquet(path).drop(DAY, BATCH)


def run_hourly_last(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    value: str,
    late: str = "1 day",
) -> StreamingQuery:
    """Last non-null value per key and hour as a versioned table at ``path``; late rows change their hour too.

    Each hour is stored with the time of its value, so a batch merges with the
    stored days it touches, in any order and any number of times. How many rows of
    each hour came late is kept per batch in ``<path>-late``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(_marked(batch, batch_id, path, ts, late), "stream-batch")
        _clock(rows, batch_id, path, ts)
        hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("date_hour")
        known = F.col(value).isNotNull()
        newest = F.max(F.when(known, F.struct(F.col(ts).cast("timestamp_ntz").alias("t"), F.col(value).alias("v"))))
        hours = rows.groupBy(*keys, hour).agg(newest.alias("newest")).withColumn(DAY, F.to_date("date_hour"))
        upsert(hours, path, [*keys, "date_hour"], partition_by=DAY, version=["newest"])
        behind = rows.where(LATE).groupBy(*keys, hour).agg(F.count("*").alias("rows"))
        behind.write.mode("overwrite").parquet(_batch_folder(f"{path}-late", batch_id))

    return _started(stream, checkpoint, store, "append")


def hourly_rows(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, date_hour, value`` of the table that ``run_hourly_last`` keeps."""
    return read_version(spark, path).select(*keys, "date_hour", F.col("newest.v").alias(value))


def late_counts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``keys, date_hour, rows``: how many rows of each hour came late."""
    return spark.read.parquet(f"{path}-late").groupBy(*keys, "date_hour").agg(F.sum("rows").alias("rows"))


def _started(stream: DataFrame, checkpoint: str, store, mode: str) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(store).start()
