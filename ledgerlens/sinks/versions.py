"""Tables that are replaced by publishing a new version, never in place.

Below a table's folder, ``data/v<n>`` holds the files written by version n and
``manifest/v<n>`` one small table that names the folders making up the whole
table. A version exists once Spark has committed its manifest (``_SUCCESS``), so
a write that fails at any point leaves the version before as it was. A version
may keep folders of earlier ones: only changed partitions are written again.

Rows are stored whole, partition column included, and read with the schema the
manifest declares, so nothing is inferred from folder names.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import ROWS_PER_FILE

PART = "_part"
WHOLE = "all"
MANIFEST = "part string, folder string, schema string, partition_by string"


class TableBroken(RuntimeError):
    """The folder holds something, but no table of this layout."""


class VersionTaken(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: dict[str, str]
    schema: T.StructType
    partition_by: str | None


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[1:]) for n in _names(spark, path) if n[:1] == "v" and n[1:].isdigit())


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest published version; None if nothing was ever published here.

    A folder that holds other things than a table of this layout is an error, so
    a broken table is never taken for a new one.
    """
    for number in reversed(_numbers(spark, f"{path}/manifest")):
        if "_SUCCESS" in _names(spark, f"{path}/manifest/v{number}"):
            rows = spark.read.schema(MANIFEST).json(f"{path}/manifest/v{number}").collect()
            if not rows:
                raise TableBroken(f"{path}: manifest {number} is empty")
            folders = {r.part: f"{path}/{r.folder}" for r in rows if r.part is not None}
            return Version(number, folders, T.StructType.fromJson(_json(rows[0].schema)), rows[0].partition_by)
    other = set(_names(spark, path)) - {"data", "manifest"}
    if other:
        raise TableBroken(f"{path} has files, but no published version: {sorted(other)[:3]}")
    return None


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def read_version(spark: SparkSession, path: str, parts: set[str] | None = None) -> DataFrame:
    """The published table, or only its partitions with the keys ``parts``."""
    version = current_version(spark, path)
    if version is None:
        raise TableBroken(f"{path}: no published version")
    return read_folders(spark, version, parts)


def read_folders(spark: SparkSession, version: Version, parts: set[str] | None = None) -> DataFrame:
    folders = [f for p, f in sorted(version.folders.items()) if parts is None or p in parts]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def part_key(partition_by: str) -> Column:
    """A partition value as a folder name: the bytes of its text in hex; ``null`` and ``empty`` apart."""
    text = F.col(partition_by).cast("string")
    return F.when(text.isNull(), "null").when(text == "", "empty").otherwise(F.hex(F.encode(text, "UTF-8")))


def publish(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    kept: dict[str, str] | None = None,
    based_on: Version | None = None,
) -> int:
    """Writes ``df`` and publishes it, with the folders in ``kept``, as the next version.

    Two writers that start from one version write different folders, and the
    second to publish fails.
    """
    spark = df.sparkSession
    number = (based_on.number if based_on else 0) + 1
    target = f"data/v{number}-{uuid4().hex[:12]}"
    rows = df.withColumn(PART, part_key(partition_by) if partition_by else F.lit(WHOLE))
    if partition_by:
        # Few files for a small partition, several tasks for a large one.
        rows = rows.hint("rebalance", PART)
    writer = rows.write
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(PART).parquet(f"{path}/{target}")
    written = [n.removeprefix(f"{PART}=") for n in _names(spark, f"{path}/{target}") if n.startswith(f"{PART}=")]
    folders = {p: f.removeprefix(f"{path}/") for p, f in (kept or {}).items()}
    folders |= {p: f"{target}/{PART}={p}" for p in written}
    # The row without a part carries the schema of a table that has no rows.
    rows = [(p, f, df.schema.json(), partition_by) for p, f in [(None, None), *sorted(folders.items())]]
    aside = f"{path}/manifest/.v{number}-{uuid4().hex[:12]}"
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(aside)
    final = f"{path}/manifest/v{number}"
    files, folder = _folder(spark, final)
    if files.exists(folder):
        if "_SUCCESS" in _names(spark, final):
            raise VersionTaken(f"{path}: version {number} was published by another writer")
        files.delete(folder, True)  # left by a writer that died
    if not files.rename(_folder(spark, aside)[1], folder):
        raise VersionTaken(f"{path}: version {number} could not be published")
    return number


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the newest ``keep`` versions and the data none of them uses.

    To be called when nothing reads older versions any more and no write is going on.
    """
    published = [n for n in _numbers(spark, f"{path}/manifest") if "_SUCCESS" in _names(spark, f"{path}/manifest/v{n}")]
    newest = {f"v{n}" for n in published[-keep:]}
    kept = spark.read.schema(MANIFEST).json([f"{path}/manifest/{name}" for name in newest]) if newest else None
    used = set() if kept is None else {r.folder.split("/")[1] for r in kept.where("folder is not null").collect()}
    for place, wanted in (("data", used), ("manifest", newest)):
        for name in _names(spark, f"{path}/{place}"):
            if name not in wanted:
                files, folder = _folder(spark, f"{path}/{place}/{name}")
                files.delete(folder, True)
