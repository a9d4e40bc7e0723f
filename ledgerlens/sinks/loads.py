"""Load log: which load wrote which rows."""

from __future__ import annotations

from datetime import datetime

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ROWS_PER_FILE

LOADS_SCHEMA = (
    "load_id string, schema_name string, status int, inserted_at timestamp_ntz, "
    "row_count bigint, schema_version_hash string"
)


def schema_hash(df: DataFrame) -> str:
    import hashlib

    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def append_load(
    df: DataFrame, path: str, loads_path: str, load_id: str, schema_name: str, at: datetime
) -> None:
    """Stores rows stamped with the load id, then logs the load.

    A load id owns a folder of ``path`` and one of ``loads_path``, so repeating a
    load replaces its rows and its log entry. Rows are counted while they are
    written; a load without an entry in the log did not finish.
    """
    spark: SparkSession = df.sparkSession
    seen = Observation(f"load-{uuid4().hex}")
    stamped = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    stamped.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{path}/_load_id={load_id}")
    entry = [(load_id, schema_name, 0, at, seen.get["rows"], schema_hash(df))]
    logged = spark.createDataFrame(entry, LOADS_SCHEMA).drop("load_id").coalesce(1)
    logged.write.mode("overwrite").parquet(f"{loads_path}/load_id={load_id}")


def read_loads(spark: SparkSession, path: str, rows: str) -> DataFrame:
    """The rows of all loads with their ``_load_id`` as text; ``rows`` is their schema."""
    return spark.read.schema(f"{rows}, _load_id string").parquet(path)


def read_load_log(spark: SparkSession, loads_path: str) -> DataFrame:
    return spark.read.schema(LOADS_SCHEMA).parquet(loads_path)
