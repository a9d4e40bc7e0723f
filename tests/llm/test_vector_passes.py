"""Vector searches in several passes and many small tasks, and how their blocks meet."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_phrases_simhash_negatives import embedded, plain_negatives
from test_vectors_mixing_chat import cloud, good, padded, vectors

from ledgerlens.llm import hamming_index, hard_negatives, top_products, vector_blocks


def small(monkeypatch):
    for name, value in {"BLOCK_ROWS": 16, "QUERY_ROWS": 3, "GROWTH": 2, "SCORED": 2}.items():
        monkeypatch.setattr(vector_blocks, name, value)


def test_blocks_meet_without_copies_or_broadcasts(spark):
    held = spark.range(20).select(F.lit(1).alias("bucket"), F.col("id").alias("part"), F.col("id").alias("items"))
    asked = spark.range(3).select(F.col("id").alias("block"), F.col("id").alias("asked"))
    met = vector_blocks.paired(asked, held)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert not any(word in plan for word in ("Broadcast", "Exchange", "Generate"))
    assert met.select("part", "block").distinct().count() == met.count() == 60


def test_passes_read_growing_parts(spark, monkeypatch):
    small(monkeypatch)
    rows = [(i, [float(i)], [i]) for i in range(300)]
    found = spark.createDataFrame(rows, "rep long, v array<double>, ids array<long>")
    held = vector_blocks.blocks(found, F.when(F.col("rep") % 3 == 0, 7).otherwise(4))
    sizes = [part.agg(F.sum("size")).first()[0] for part in vector_blocks._growing(held)]
    assert len(sizes) == len(vector_blocks.parts_of(300, 16)) == 4  # 16, 32, 64 and 128 rows at least, by whole blocks
    assert sizes == sorted(sizes) and sizes[0] < 60 and 100 < sizes[-1] < 300
    assert held.agg(F.sum("size")).first()[0] == 300


def test_blocks_of_one_bucket_are_made_in_many_tasks(spark, monkeypatch):
    small(monkeypatch)
    found = spark.range(600).select(F.col("id").alias("rep"), F.array(F.col("id").cast("double")).alias("v"), F.array("id").alias("ids"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = vector_blocks.blocks(found, F.size("v"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert held.agg(F.sum("size")).first()[0] == 600
    assert len(held.inputFiles()) > 2


def test_files_of_blocks_are_read_in_pieces(spark):
    """A reader decodes a row group at once, so it may hold a few blocks only."""
    values = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: F.sin(F.col("id") * 64 + k))
    found = spark.range(40_000).select(F.col("id").alias("rep"), values.alias("v"), F.array("id").alias("ids"))
    held = vector_blocks.blocks(found, F.size("v"))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in held.inputFiles()]
    assert max(m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)) <= 6


def test_top_products_in_many_passes(spark, monkeypatch):
    small(monkeypatch)
    rows = cloud()
    got = {}
    for r in top_products.top_products(vectors(spark, rows).repartition(5), F.col("id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    held = {i: np.floor(1024 * padded(v)) for i, v in rows if i is not None and good(v)}
    for q in (i for i in held if i % 50 == 0):
        scored = sorted(((-int(held[q] @ v), i) for i, v in held.items() if i != q))[:10]
        assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(scored, 1)]


def test_nearest_in_many_passes(spark, monkeypatch):
    table = vectors(spark, cloud())
    whole = sorted(map(tuple, hamming_index.nearest(table, F.col("id") % 50 == 0, 5).collect()))
    small(monkeypatch)
    monkeypatch.setattr(hamming_index, "COMPARED", 2)
    found = sorted(map(tuple, hamming_index.nearest(table, F.col("id") % 50 == 0, 5).collect()))
    assert [r[:3] for r in found] == [r[:3] for r in whole]
    assert np.allclose([r[3] for r in found], [r[3] for r in whole], rtol=0, atol=1e-12)


def test_hard_negatives_in_many_passes(spark, monkeypatch):
    for name, value in {"BLOCK_ROWS": 8, "ASKED_ROWS": 3, "ZONES": 2, "FIRST_ROWS": 8, "PART_ROWS": 16}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    r = np.random.default_rng(9)
    rows = [(i, (r.normal(size=6) * (0.2 if i % 3 else 1.0)).astype(np.float32).tolist(), int(r.integers(0, 3))) for i in range(200)]
    got = hard_negatives.hard_negatives(embedded(spark, rows), F.col("id") % 10 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)
