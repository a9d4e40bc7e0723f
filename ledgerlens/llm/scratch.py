"""Deleting stored intermediate tables that nothing reads any more."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import shared_folder


def discard(stored: DataFrame) -> None:
    """Deletes the folder of a table that ``materialize`` wrote, and only such a folder.

    Shuffle files of the queries finished so far go too, see ``collect_garbage``.
    """
    spark = stored.sparkSession
    files = stored.inputFiles()
    if not files:
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    if folder.getParent().toUri().getPath() != spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/ledgerlens").toUri().getPath():
        raise ValueError(f"not a scratch table: {folder}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    collect_garbage(spark)


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files of finished queries go when the driver collects its garbage, so it is asked to."""
    gc.collect()
    spark._jvm.System.gc()


def _sources(rows: DataFrame) -> set[str]:
    """Paths of the folders that the plan of ``rows`` reads."""
    leaves, found = rows._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() == "LogicalRelation" or leaf.getClass().getSimpleName() == "LogicalRelation":
            paths = leaf.relation().location().rootPaths()
            found |= {paths.apply(k).toUri().getPath() for k in range(paths.size())}
    return found


def release(folders: list[str], rows: DataFrame) -> None:
    """Deletes those of the scratch ``folders`` that the plan of ``rows`` does not read, and takes them off the list."""
    spark = rows.sparkSession
    read = _sources(rows)
    for folder in list(folders):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath() not in read:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            folders.remove(folder)
    collect_garbage(spark)
