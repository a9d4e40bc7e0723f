"""Landed JSON snapshots flattened into rows.

A snapshot is one JSON document per row in a text column, usually next to a
content tag and a fetch time. Objects keyed by entity are parsed as maps, so a
new entity needs no schema change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``payload``, ``fetched_at`` and a content ``etag``."""
    return (
        spark.read.option("wholetext", "true")
        .text(path)
        .select(
            F.col("value").alias("payload"),
            F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("fetched_at"),
        )
        .transform(stamp_snapshot)
    )


def stamp_snapshot(
    df: DataFrame, payload: str = "payload", etag: str = "etag", fetched_at: str = "fetched_at"
) -> DataFrame:
    """Fills a missing tag from the payload's content and names the fetch time ``date_time``."""
    given = F.col(etag) if etag in df.columns else F.lit(None).cast("string")
    return df.withColumn("etag", F.coalesce(given, F.sha2(F.col(payload), 256))).withColumn(
        "date_time", F.col(fetched_at)
    )


def read_json_list(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Files holding a JSON array (with ``lines`` one array per line), one row per item.

    Fields outside the schema are dropped. Declaring large integers as text keeps
    all their digits.
    """
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).json(path)


def explode_list(df: DataFrame, payload: str, item_schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """``[{...}, ...]`` to one row per item with its fields as columns."""
    items = F.from_json(F.col(payload), f"array<struct<{item_schema}>>")
    return df.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.*")


def explode_map(
    df: DataFrame,
    payload: str,
    keys: Sequence[str],
    value: str | Mapping[str, str],
    keep: Sequence[str] = (),
    drop_null: bool = False,
) -> DataFrame:
    """Nested objects ``{k1: {k2: ... value}}`` to one row per path.

    ``keys`` names one column per level. ``value`` is the name of a scalar text
    column, or a mapping of output names to JSON field names when the innermost
    value is an object; its fields stay text until typed. Absent or null levels
    give no rows; ``drop_null`` also drops paths that end in a JSON null.
    """
    if isinstance(value, str):
        inner = "string"
    else:
        inner = "struct<" + ", ".join(f"`{f}` string" for f in value.values()) + ">"
    kind = inner
    for _ in keys:
        kind = f"map<string,{kind}>"
    rows = df.select(*keep, F.from_json(F.col(payload), kind).alias("_node"))
    done: list[str] = []
    for key in keys:
        rows = rows.select(*keep, *done, F.explode("_node").alias(key, "_node"))
        done.append(key)
    if drop_null:
        rows = rows.where(F.col("_node").isNotNull())
    if isinstance(value, str):
        return rows.withColumnRenamed("_node", value)
    return rows.select(
        *keep, *done, *[F.col("_node").getField(f).alias(name) for name, f in value.items()]
    )


def number_or_null(text: Column, kind: str = "double") -> Column:
    """Numeric text; the text NaN and anything unreadable become NULL."""
    return F.nullif(text, F.lit("NaN")).try_cast(kind)
