"""As-of left join: for each left row, the latest right row not after it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialize


def _slice_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000))


def asof_join_left(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    columns: Sequence[str],
    *,
    tie_break: Sequence[str] = (),
    slice_seconds: int = 3600,
    match_flag: str | None = None,
) -> DataFrame:
    """Left rows plus ``columns`` of the latest right row with ``right_ts <= left_ts``.

    All left rows are kept. A matched right row whose values are NULL still
    counts as a match (``match_flag`` names an optional boolean column for it).
    Among right rows of one key and time, the greatest ``tie_break`` wins, then
    the greatest ``columns``.

    No key is ever sorted in one piece. The match depends only on (key, time),
    so the left side is reduced to distinct (key, time) probes and the right
    side to one row per (key, time), both combined before the shuffle. Probes
    and right rows then meet per (key, time slice); a slice with no earlier
    right row takes the closing value of an earlier slice, found over one row
    per (key, slice). A final equi-join brings the answer back to the left rows
    and is open to runtime skew splitting.
    """
    on = list(on)
    ranked = F.struct(*[F.col(c) for c in (*tie_break, *columns)])
    quotes = (
        right.where(F.col(right_ts).isNotNull())
        .groupBy(*on, F.col(right_ts).alias("_ts"))
        .agg(F.max(ranked).alias("_quote"))
        .withColumn("_slice", _slice_of(F.col("_ts"), slice_seconds))
    )
    probes = (
        left.where(F.col(left_ts).isNotNull())
        .select(*on, F.col(left_ts).alias("_ts"))
        .distinct()
        .withColumn("_slice", _slice_of(F.col("_ts"), slice_seconds))
    )
    timeline = quotes.withColumn("_probe", F.lit(0)).unionByName(
        probes.withColumn("_probe", F.lit(1)), allowMissingColumns=True
    )
    # Right rows sort first at equal times, which makes the bound inclusive.
    inside = (
        Window.partitionBy(*on, "_slice")
        .orderBy("_ts", "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_slice = (
        timeline.withColumn("_quote", F.last("_quote", ignorenulls=True).over(inside))
        .where(F.col("_probe") == 1)
        .drop("_probe")
    )
    before = (
        Window.partitionBy(*on)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = (
        timeline.groupBy(*on, "_slice")
        .agg(F.max(F.when(F.col("_probe") == 0, F.struct("_ts", "_quote"))).alias("_close"))
        .withColumn("_open", F.last("_close", ignorenulls=True).over(before)["_quote"])
        .where(F.col("_open").isNotNull())
        .select(*on, "_slice", "_open")
    )
    answers = in_slice.join(opening, [*on, "_slice"], "left").select(
        *on,
        F.col("_ts").alias(left_ts),
        F.coalesce("_quote", "_open").alias("_quote"),
    )
    joined = left.join(answers, [*on, left_ts], "left")
    kept = [F.col(c) for c in left.columns]
    if match_flag:
        kept.append(F.col("_quote").isNotNull().alias(match_flag))
    return joined.select(*kept, *[F.col("_quote")[c].alias(c) for c in columns])


def _filler():
    """A function on the batches of a sorted partition; made here so that it travels to workers with its code."""

    def fill(batches):
        # Left rows with the last right row before them, then the partition's last right row.
        part, last, kinds = TaskContext.get().partitionId(), None, None
        names = ["_part", "_row", "_quote", "_edge"]
        for batch in batches:
            rows, quotes = batch.column("_row"), batch.column("_quote")
            kinds = rows.type
            side = batch.column("_side").to_numpy()
            pool = quotes if last is None else pa.concat_arrays([last, quotes])
            first = len(pool) - len(quotes)
            place = np.where(side == 0, np.arange(len(side)) + first, first - 1)
            place = np.maximum.accumulate(place) if len(place) else place
            mine = np.flatnonzero(side == 1)
            found = pool.take(pa.array(place[mine], mask=place[mine] < 0))
            ids, edge = pa.array(np.full(len(mine), part, np.int32)), pa.array(np.zeros(len(mine), bool))
            yield pa.RecordBatch.from_arrays([ids, rows.take(pa.array(mine)), found, edge], names)
            if len(place) and place[-1] >= 0:
                last = pool.slice(place[-1], 1)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.nulls(1, kinds), last, pa.array([True])], names)

    return fill


def asof_join_ranged(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    columns: Sequence[str],
    *,
    tie_break: Sequence[str] = (),
    match_flag: str | None = None,
) -> DataFrame:
    """The same join in one pass over both sides.

    Rows of both sides are put in one order (key, time, right before left) and
    range-partitioned by all of it, so neither a hot key nor many rows of one
    moment meet in one task. A task walks its part once, in Arrow batches, and
    gives each left row the last right row before it; rows that stand before the
    first right row of their part take the last one of the parts before. For that
    one row per partition reaches the driver and goes back as a broadcast.

    The result of the walk is stored: a lost executor rereads it.
    """
    on, spark = list(on), left.sparkSession
    row_type = T.StructType(left.schema.fields)
    quote = F.struct(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(on)],
        *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_break)],
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    keys = [f"_k{i}" for i in range(len(on))]
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*on, right_ts)])
    quotes = right.where(known).select(
        *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)],
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(row_type).alias("_row"),
        quote.alias("_quote"),
    )
    quote_type = quotes.schema["_quote"].dataType
    rows = left.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)],
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"),
        F.lit(None).cast(quote_type).alias("_quote"),
    )
    # Nulls come first: a left row without a time stands before all right rows of its key.
    order = [*keys, "_ts", "_side", "_quote", "_spread"]
    tagged = quotes.unionByName(rows).withColumn("_spread", F.xxhash64("_row"))
    ordered = tagged.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType().add("_part", T.IntegerType()).add("_row", row_type).add("_quote", quote_type).add("_edge", T.BooleanType())
    placed = materialize(ordered.select("_side", "_row", "_quote").mapInArrow(_filler(), schema), "asof")

    ends = {r["_part"]: r["_quote"] for r in placed.where("_edge").select("_part", "_quote").collect()}
    parts = placed.agg(F.max("_part")).first()[0]
    carried, last = [], None
    for part in range((-1 if parts is None else parts) + 1):
        if last is not None:
            carried.append((part, last))
        last = ends.get(part, last)
    carry = spark.createDataFrame(carried, T.StructType().add("_part", T.IntegerType()).add("_carried", quote_type))
    met = placed.where(~F.col("_edge")).join(F.broadcast(carry), "_part", "left")
    nearest = F.coalesce("_quote", "_carried")
    # The nearest right row in the order may belong to an earlier key.
    same = reduce(Column.__and__, [nearest[f"k{i}"].eqNullSafe(F.col("_row")[c]) for i, c in enumerate(on)])
    timed = F.col("_row")[left_ts].isNotNull()
    met = met.withColumn("_match", F.when(nearest.isNotNull() & same & timed, nearest))
    kept = [F.col("_row")[c].alias(c) for c in left.columns]
    if match_flag:
        kept.append(F.col("_match").isNotNull().alias(match_flag))
    return met.select(*kept, *[F.col("_match")[f"v{i}"].alias(c) for i, c in enumerate(columns)])
