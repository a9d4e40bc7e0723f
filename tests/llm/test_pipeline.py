"""The stages of the pipeline on a small corpus with known contents."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from helpers import documents, prose, write
from pyspark.sql import functions as F

from ledgerlens.llm.queries import vocabulary_path
from ledgerlens.session import materialize

EN = "the and that of with this from which have been were their would there about when said people".split()
DE = "der die das und nicht mit von sich auch auf eine nach werden haben einen wurde sind über".split()


def sentence(words, seed, count):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", "e", "er"]) for _ in range(count))


@pytest.fixture
def folder(spark, tmp_path):
    passage = " ".join(prose(77, 60))
    rows = [(k, sentence(EN if k % 2 else DE, k, 60)) for k in range(60)]
    rows += [(100, rows[4][1]), (101, rows[5][1] + " tail"), (200, "123 %% 456"), (201, None), (202, "")]
    rows += [(300, sentence(EN, 900, 50) + " " + passage), (301, passage + " " + sentence(EN, 901, 50)), (302, "idiot moron " * 30)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)] + [(302, 0, 1)], "doc_id long, quality int, toxic int")
    return write(spark, tmp_path, documents=docs, labels=labels)


def test_each_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near-duplicates", "repeated-passages", "mixing", "sentencepiece"]

    told = stages["language"](spark, docs, folder)
    ids = {r.doc_id for r in told.collect()}
    assert told.columns == columns and not ids & {200, 201, 202} and ids >= set(range(60))

    single = stages["near-duplicates"](spark, told, folder)
    ids = {r.doc_id for r in single.collect()}
    assert single.columns == columns and not ids & {100, 101} and ids >= set(range(60)) | {300, 301}

    cleaned = stages["repeated-passages"](spark, single, folder)
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert cleaned.columns == columns and set(texts) == ids
    assert texts[301] == sentence(EN, 901, 50) and texts[300] == before[300] and texts[7] == before[7]

    mix = stages["mixing"](spark, cleaned, folder)
    assert mix.columns == columns and set(range(60)) <= {r.doc_id for r in mix.collect()}

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    coded = stages["sentencepiece"](spark, cleaned, folder).collect()
    assert {r.doc_id: r.ids for r in coded} == {k: library.encode(t) + [2] for k, t in texts.items()}


def test_stages_follow_each_other(spark, folder):
    assert corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    want = Counter((r.doc_id, tuple(r.ids)) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_stages_without_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = write(spark, tmp_path, documents=documents(spark, []), labels=labels)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_keep_other_columns_of_any_name(spark, folder):
    names = ["score", "copies", "copy", "kept", "lang_pred", "rated_id", "k0", "n_words", "column_5", "Kept words", "equal"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").drop("n_chars", "source")
    plain, wide = docs, docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, wide = (materialize(stage(spark, d, folder), name) for d in (plain, wide))
        assert wide.columns == ["doc_id", "text", "lang", *names]
        assert Counter(map(tuple, wide.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
        assert all(r[n] == f"{n}{r.doc_id}" for r in wide.collect() for n in names)


def test_batches_of_long_texts_are_bounded_by_their_bytes(spark, folder):
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(2_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        corpus_pipeline.known_language(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 6_000_000
        spark.conf.set(key, "1m")
        corpus_pipeline.known_language(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_shuffle_files_go_with_a_scratch_table(spark, monkeypatch):
    from ledgerlens.llm import scratch

    asked = []
    monkeypatch.setattr(scratch.gc, "collect", lambda: asked.append(1))
    scratch.discard(materialize(spark.range(9), "garbage"))
    assert asked


def test_a_stage_frees_what_stored_stages_left(spark, folder):
    from pathlib import Path

    from ledgerlens import session

    before = len(session.scratch_folders)
    docs = corpus_pipeline.one_of_each(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    own = session.scratch_folders[before:]
    docs = materialize(docs, "kept")
    lazy = corpus_pipeline.without_repeats(spark, docs, folder)
    assert len(own) > 3 and not any(Path(f).exists() for f in own) and Path(session.scratch_folders[before + len(own)]).exists()
    # What a plan that is not stored still reads stays.
    assert lazy.count() == corpus_pipeline.token_ids(spark, lazy, folder).count()
