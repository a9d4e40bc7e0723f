"""Shared small inputs."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, rows, **more):
    """A documents table of (doc_id, text) pairs, with constant extra columns in ``more``."""
    from pyspark.sql import functions as F

    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).withColumns({k: F.lit(v) for k, v in more.items()})


def prose(seed: int, words: int, vocabulary: int = 5_000) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(words)]


def write(spark, folder, **tables):
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
