"""The corpus pipeline: five stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import language_id, mixing, near_dup, pieces, repeated_spans
from ledgerlens.llm.queries import FLOORS, TARGETS, domains_of, vocabulary_path
from ledgerlens.llm.scratch import release
from ledgerlens.llm.share import share_package
from ledgerlens.session import ensure_batches, materialize, scratch_folders

#: A document stays if its predicted language is at least this probable.
LANGUAGE_SCORE = 0.5


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(build: Stage) -> Stage:
    """A stage over documents with any further columns, whatever their names.

    The first step frees what earlier stages stored for themselves, unless ``docs``
    is a plan that still reads it. Columns other than ``doc_id`` and ``text`` go
    through ``build`` under names that nothing else uses.
    """

    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(_stored, docs)
        share_package(spark)
        ensure_batches(spark)
        before = len(scratch_folders)
        own = {c: c if c in OWN else f"column_{i}" for i, c in enumerate(docs.columns)}
        built = build(spark, docs.select(*[F.col(f"`{c}`").alias(name) for c, name in own.items()]), sf_dir)
        _stored.extend(scratch_folders[before:])
        names = {name: c for c, name in own.items()}
        return built.select(*[F.col(c).alias(names.get(c, c)) for c in built.columns])

    return run


#: Scratch folders of stages that ran.
_stored: list[str] = []
#: Columns that stages read.
OWN = ("doc_id", "text", "lang", "n_chars")


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without a letter and undecided ones go."""
    learned = docs.where(~language_id.held_out()).select("doc_id", "text", "lang")
    model = language_id.train(learned, vocabulary_path("piece_bpe_32k.model"))
    told = language_id.identify(docs, model, keep=[c for c in docs.columns if c != "doc_id"])
    kept = told.where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SCORE))
    return kept.select(*docs.columns)


@stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates.

    Repeated rows of a kept document stay for the stages that follow; rows
    without a doc_id stay too.
    """
    found = near_dup.near_duplicates(docs)
    dropped = found.where(~F.col("kept")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


@stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that an earlier document holds.

    A document that loses no word keeps its text as it is; else the words left are
    joined by single spaces and ``n_chars``, if there is one, is counted anew.
    Documents that lose every word go.
    """
    left = repeated_spans.remove_repeats(docs, keep=[c for c in docs.columns if c != "doc_id"])
    left = left.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    whole = F.col("n_removed") == 0
    anew = {"text": F.col("kept_words"), "n_chars": F.length("kept_words").cast("long")}
    return left.select(*[F.when(whole, F.col(c)).otherwise(anew[c]).alias(c) if c in anew else c for c in docs.columns])


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as its rate asks for; only rates below one leave documents out."""
    labels = domains_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = mixing.mix(docs, labels, TARGETS, FLOORS).select(F.col("doc_id").alias("rated_id"), "copies")
    # A bound on rows per document comes from its rate; the join may be split at a hot document.
    joined = docs.join(rated, docs["doc_id"].eqNullSafe(rated["rated_id"])).where("copies > 0")
    rows = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(*[docs[c] for c in docs.columns])


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of each document, with the end id."""
    ids = pieces.encode_pieces(docs, vocabulary_path("piece_bpe_32k.model"))
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near-duplicates", one_of_each),
    ("repeated-passages", without_repeats),
    ("mixing", mixed),
    ("sentencepiece", token_ids),
]

#: Neither trained models nor tokenizers can be written as SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, run_stage in STAGES:
        docs = materialize(run_stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
