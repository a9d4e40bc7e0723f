"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # collect_list / percentile stay hash based until this many groups per task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}
#: What the wide marts need of any session, unless it says otherwise.
WIDE = {
    # The JVM never compiles a method of more than 8000 bytes; a projection of fifty columns is one, if left whole.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows of the dimensions take some sixteen times the room of their files; by the files' size
    # alone, far too many of them would be collected by the driver for a broadcast.
    "spark.sql.sources.fileCompressionFactor": "16.0",
}
#: What operators with Python tasks need of any session, unless it says otherwise.
BATCHES = {
    # Spark's own bound of 10,000 rows lets long texts make batches of any size; the JVM holds each of them twice
    # outside its heap and the worker once.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


ROWS_PER_FILE = 1_000_000


def build_session(
    app_name: str = "ledgerlens",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **WIDE, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Time bucketing is defined in UTC, whatever zone the session came with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_wide(spark: SparkSession) -> SparkSession:
    """The settings of ``WIDE`` where the session still has Spark's own."""
    for key, value in WIDE.items():
        if spark.conf.get(key) in ("65535", "1.0"):
            spark.conf.set(key, value)
    return spark


def ensure_batches(spark: SparkSession) -> SparkSession:
    """The settings of ``BATCHES`` where the session still has Spark's own."""
    for key, value in BATCHES.items():
        if spark.conf.get(key) in ("67108864b", "64MB"):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without the setting; a cluster without a
    shared folder is a configuration error, not a reason to use local disks.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        folder = context._jsc.sc().getCheckpointDir()
        configured = folder.get() if folder.isDefined() else None
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


#: Scratch folders named by this process, in order.
scratch_folders: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    scratch_folders.append(f"{shared_folder(spark)}/ledgerlens/{label}-{uuid.uuid4().hex}")
    return scratch_folders[-1]


def materialize(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on the plan above it, so a lost executor
    rereads files instead of recomputing, and values such as partition ids stay
    what they were when written. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(maxRecordsPerFile=ROWS_PER_FILE, **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
