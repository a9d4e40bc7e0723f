"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def share_package(spark: SparkSession) -> None:
    """Ships the package with the application, once, unless the workers find it on their path anyway."""
    on_path = {str(Path(p).resolve()) for p in os.environ.get("PYTHONPATH", "").split(":") if p} | {os.getcwd()}
    context = spark.sparkContext
    if str(ROOT) in on_path or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    target = Path(tempfile.mkdtemp(prefix="ledgerlens-code-")) / "ledgerlens.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted((ROOT / "ledgerlens").rglob("*.py")):
            archive.write(file, file.relative_to(ROOT))
    context.addPyFile(str(target))
