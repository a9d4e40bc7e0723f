"""Passages that other documents repeat, found level by level.

A window is a run of ``WINDOW`` words. Level by level, only what is repeated at
one length is extended to a longer one:

1. Whole word sequences. A document equal to one with a smaller id is covered
   entirely and offers nothing the smaller one does not: it leaves.
2. Anchors: each window selects the smallest-hashed of its runs of ``ANCHOR``
   words, so equal windows select equal anchors and few runs are selected. Runs
   found in one document only drop out.
3. Windows around repeated anchors, with the smallest document that holds each.

``longest_repeats`` carries on from there to runs of twice the length while any
are repeated.

Words are cut at ASCII white space and otherwise unchanged. Nulls: a null text
has no words; rows without a doc_id are kept whole and remove nothing. Repeated
rows of one doc_id never remove each other and each get a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import list_array, text_slices
from ledgerlens.llm.memo import enter
from ledgerlens.llm.scratch import discard
from ledgerlens.llm.shingles import windows, word_hashes
from ledgerlens.session import materialize

WINDOW, ANCHOR = 13, 7


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``anchor`` words, and for each window the position of the run it selects."""
    runs = windows(hashes, anchor)
    span = window - anchor + 1
    if len(runs) < span:
        return runs, np.zeros(0, dtype=np.int64)
    return runs, sliding_window_view(runs, span).argmin(axis=1) + np.arange(len(runs) - span + 1)


def _outline(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc, whole, anchors`` of ``doc, text``: hash of all words, and distinct selected runs."""

    def run(batches):
        enter("repeated_spans")
        for batch, texts in text_slices(batches, "text", rows=512):
            whole, anchors = [], []
            for text in texts:
                words = _words(text)
                hashes = word_hashes(words)
                runs, chosen = _anchors(hashes, window, anchor)
                anchors.append(np.unique(runs[chosen]).view(np.int64))
                whole.append(xxhash.xxh3_128_digest(b" ".join(words)) if len(words) >= window else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(whole, pa.binary()), list_array(anchors, pa.int64())],
                ["doc", "whole", "anchors"],
            )

    return rows.mapInArrow(run, "doc long, whole binary, anchors array<long>")


def _packed(rows: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for the way through a shuffle."""

    def run(batches):
        enter("repeated_spans")
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch, texts in text_slices(batches, "text", rows=512):
            data = [None if t is None else pack(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(data, pa.binary())], ["doc", "packed"])

    return rows.mapInArrow(run, "doc long, packed binary")


def _unpacked(data: bytes | None) -> str | None:
    if data is None:
        return None
    return zstandard.ZstdDecompressor().decompressobj().decompress(data).decode("utf-8", "surrogatepass")


def _candidates(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc, at, hash`` of the windows whose anchor is listed in ``found``."""

    def run(batches):
        enter("repeated_spans")
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                hashes = word_hashes(_words(_unpacked(part.column("packed")[0].as_py())))
                runs, chosen = _anchors(hashes, window, anchor)
                found = part.column("found").flatten().to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(runs[chosen], found))
                doc = np.full(len(at), part.column("doc")[0].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(at, pa.int32()), pa.array(windows(hashes, window)[at].view(np.int64))],
                    ["doc", "at", "hash"],
                )

    return rows.mapInArrow(run, "doc long, at int, hash long")


def _moved(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` once, for a grouping and the join with its result.

    Both read the same shuffle as long as they use the same columns and no filter of one goes below it:
    each has to use all columns, and NULLs, of which there are none, are left out before.
    """
    for name in rows.columns:
        rows = rows.where(F.col(name).isNotNull())
    return rows.repartition(key)


def _repeated_runs(outline: DataFrame) -> DataFrame:
    """``doc, found``: the runs of each document that another one shares. Runs that only copies of one share lead nowhere."""
    runs = outline.select("doc", F.xxhash64("whole").alias("content"), F.explode("anchors").alias("run"))
    runs = _moved(runs, "run")
    many = runs.groupBy("run").agg(F.min("content").alias("x"), F.max("content").alias("y"), F.min("doc").alias("low"))
    many = many.where("x <> y and low is not null").select(F.col("run").alias("many"), "x")
    return runs.join(many, F.expr("run = many and content >= x")).groupBy("doc").agg(F.collect_set("run").alias("found"))


def repeated_windows(docs: DataFrame, id_col="doc_id", text_col="text", window=WINDOW, anchor=ANCHOR):
    """(windows, copies) of the documents.

    windows: ``doc, at, hash, low`` for windows in more than one place; ``low`` is
    the smallest doc_id that holds the window. copies: ``doc`` of documents all of
    whose rows equal one with a smaller id, which are left out of the windows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where("doc is not null")
    outline = materialize(_outline(rows, window, anchor), "outline")
    firsts = outline.where("whole is not null").groupBy("whole").agg(F.min("doc").alias("low"))
    seen = outline.select("doc", "whole").join(firsts, "whole", "left")
    copied = F.coalesce(F.col("low") < F.col("doc"), F.lit(False))
    copies = seen.groupBy("doc").agg(F.every(copied).alias("copied")).where("copied").select("doc")
    copies = materialize(copies, "copies")
    found = _repeated_runs(outline)
    # Copies leave here and not before, where Spark would take them out of one of the two uses of the runs only.
    wanted = _packed(rows).join(found, "doc").join(copies, "doc", "left_anti")
    placed = _candidates(wanted.select("doc", "packed", "found"), window, anchor)
    placed = materialize(placed, "windows")
    discard(outline)  # the stored windows and copies have all that is still needed of it
    placed = _moved(placed, "hash")
    lows = placed.groupBy("hash").agg(F.min("doc").alias("low"), F.count("*").alias("n"), F.min("at").alias("first"))
    lows = lows.where("n > 1 and first is not null").select("hash", "low")
    return placed.join(lows, "hash").select("doc", "at", "hash", "low"), copies


def longest_repeats(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, at, length`` of runs repeated in another document, at the greatest length of window * 2**k.

    Runs repeated at one length are extended to twice the length; the loop ends
    when none are left. Rows of copies of one document count as one document.
    """
    spread = found.groupBy("hash").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y").select("hash")
    level = materialize(found.select("doc", "at", "hash").join(spread, "hash"), "level")
    length, done = window, None
    while not level.isEmpty():
        here = level.select("doc", "at", F.lit(length).alias("length"))
        done = here if done is None else done.union(here)
        second = level.select("doc", (F.col("at") - length).alias("at"), F.col("hash").alias("then"))
        pairs = level.join(second, ["doc", "at"]).select("doc", "at", F.xxhash64("hash", "then").alias("hash"))
        pairs = materialize(pairs.distinct(), "pairs")
        spread = pairs.groupBy("hash").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y").select("hash")
        level = materialize(pairs.join(spread, "hash"), "level")
        length *= 2
    if done is None:
        return found.select("doc", "at", F.lit(window).alias("length"))
    return done.groupBy("doc", "at").agg(F.max("length").alias("length"))


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", window=WINDOW, keep=()) -> DataFrame:
    """Every row with the words of repeated windows removed.

    Returns ``id_col``, the columns in ``keep``, ``n_words, n_removed, kept_words``
    (joined by one space). A word goes if a window over it also starts in a
    document with a smaller id; windows are judged on the input.
    """
    found, copies = repeated_windows(docs, id_col, text_col, window)
    spans = found.where("low < doc").groupBy("doc").agg(F.collect_set("at").alias("starts"))
    marks = spans.join(copies.withColumn("equal", F.lit(True)), "doc", "full_outer")
    extra = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"), *extra)
    names = [f"k{i}" for i in range(len(keep))]
    schema = "".join(f", k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def pack(batches):
        enter("repeated_spans")
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch, texts in text_slices(batches, "text", rows=512):
            data = [None if t is None else squeeze(t.encode("utf-8", "surrogatepass")) for t in texts]
            rest = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(data, pa.binary()), *rest], ["doc", "packed", *names])

    def run(batches):
        enter("repeated_spans")
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sizes, removed, kept = [], [], []
                columns = (part.column(c).to_pylist() for c in ("packed", "starts", "equal"))
                for packed, starts, equal in zip(*columns, strict=True):
                    words = _words(_unpacked(packed))
                    mask = np.zeros(len(words) + 1, dtype=np.int64)
                    if equal:
                        starts = range(len(words) - window + 1)
                    elif starts:
                        starts = [s for s in starts if s + window <= len(words)]
                    if starts:
                        np.add.at(mask, np.array(starts), 1)
                        np.add.at(mask, np.array(starts) + window, -1)
                    covered = np.cumsum(mask[:-1]) > 0
                    sizes.append(len(words))
                    removed.append(int(covered.sum()))
                    left = words if not starts else [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                    kept.append(b" ".join(left).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        *[part.column(n) for n in names],
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    ["doc", *names, "n_words", "n_removed", "kept_words"],
                )

    packed = rows.mapInArrow(pack, f"doc long, packed binary{schema}")
    marked = packed.join(marks, "doc", "left").select("doc", "packed", "starts", "equal", *names)
    out = marked.mapInArrow(run, f"doc long{schema}, n_words long, n_removed long, kept_words string")
    named = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(F.col("doc").alias(id_col), *named, "n_words", "n_removed", "kept_words")
