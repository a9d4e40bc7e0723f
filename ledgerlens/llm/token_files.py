"""Token ids of documents written as Simple-8b files, and read back.

A store is a folder of Parquet files whose rows are self-contained segments in
ascending document order: ``file`` and ``segment`` number them, ``first`` is the
number of ids before the segment in its file, and ``payload`` is, little endian,

    magic "S8B1", u32 documents, u32 blocks, u32 words,
    documents x (i64 doc_id, u32 ids), blocks x u32 words in the block, words x u64

A document's blocks follow from its number of ids. Ids are packed as soon as they
are known: only packed words travel to the file that takes them. Spark writes the
files, so a lost task leaves no partial one.

Nulls: a null text has no ids but the end id; a row without a doc_id comes
before all others, with id ``NO_ID`` inside the payload. Repeated doc_ids give a
row each, in the order of their ids' bytes.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm import simple8b
from ledgerlens.llm.batches import list_array, text_slices
from ledgerlens.llm.memo import WordMemo, held
from ledgerlens.session import scratch_path

NO_ID = -(2**63)
HEAD = "<4sIII"
SEGMENT_IDS = 65_536
#: White space other than the plain space and the line end (and some look-alikes: they only cost time).
OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")


def _plain(text: str) -> bool:
    """Whether all white space is single spaces and single line ends between other characters."""
    ends = text[0] in " \n" or text[-1] in " \n"
    doubled = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
    return not (ends or doubled or OTHER_SPACE.search(text))


#: A letter or digit, then a mark other than the apostrophe: a pre-token ends between them.
BEFORE_MARK = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _units(texts: list[str]) -> pa.ListArray:
    """Cuts plain texts at single spaces and line ends and before marks, where no pre-token reaches across.

    A unit stands for itself after a space; a tab in front says that there is none;
    a line end is a unit of its own.
    """
    lines = pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n \t")
    cut = pc.replace_substring_regex(lines, BEFORE_MARK, "\\1 \t\\2")
    return pc.split_pattern(pc.binary_join_element_wise("\t", cut, ""), " ")


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE's character for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """The tokenizer, and this worker's memory of the units it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = self.tokenizer.pre_tokenizer
        #: Whether pre-tokens end at spaces and line ends, so that units can be encoded on their own.
        self.by_units = isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
        self.by_units &= self.tokenizer.normalizer is None
        self.end = self.whole(["\n"])[0].tolist()
        self.by_units &= len(self.end) == 1
        self.by_units &= isinstance(self.tokenizer.model, models.BPE)
        self.model, self.characters = self.tokenizer.model, _byte_characters()
        self.memo = WordMemo(self._encode, keep=300_000, recent=100_000)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, units: list[str]) -> list[bytes]:
        """Ids of each unit. Letters after a space are one pre-token, which the model takes as it is.

        Other units are encoded many in a line, and the ids cut where the line ends stand.
        """
        out: list[bytes] = [b""] * len(units)
        tokenize, characters, others = self.model.tokenize, self.characters, []
        for i, unit in enumerate(units):
            if LETTERS.fullmatch(unit):
                if not unit.isascii():
                    unit = unit.encode().decode("latin-1").translate(characters)
                out[i] = array("I", [t.id for t in tokenize("Ġ" + unit)]).tobytes()
            else:
                others.append(i)
        for start in range(0, len(others), 200):
            places = others[start : start + 200]
            some = [u[1:] if u[0] == "\t" else u if u == "\n" else " " + u for u in map(units.__getitem__, places)]
            ids = self.whole(["\n".join(some)])[0]
            stops = np.flatnonzero(ids == self.end[0])
            if len(stops) == len(some) - 1:
                data, edges = ids.tobytes(), [0, *(4 * stops).tolist(), 4 * len(ids)]
                found = [data[a + 4 * (i > 0) : b] for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            else:  # a line end among the units themselves
                found = [i.tobytes() for i in self.whole(some)]
            for place, value in zip(places, found, strict=True):
                out[place] = value
        return out

    def _fits(self, text: str) -> bool:
        return self.by_units and bool(text) and _plain(text) and not any(s in text for s in self.special)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text), with ``end_id`` after each text."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        fits = np.array([self._fits(t) for t in texts], bool)
        units = _units([t for t, f in zip(texts, fits, strict=True) if f])
        coded = units.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        odd = self.whole([t for t, f in zip(texts, fits, strict=True) if not f])
        # Distinct units, then each other text as one, then the end.
        parts = [*self.memo.values_of(words), *[o.tobytes() for o in odd], np.array([end_id], "<u4").tobytes()]
        counts = np.ones(len(texts), np.int64)
        counts[fits] = units.value_lengths().to_numpy()
        codes = np.empty(int(counts.sum()) + len(texts), np.int64)
        ends = np.cumsum(counts + 1) - 1
        plain = np.repeat(fits, counts + 1)
        plain[ends] = False
        codes[plain] = coded.indices.to_numpy()
        codes[ends - 1] = np.where(fits, codes[ends - 1], len(words) + np.cumsum(~fits) - 1)
        codes[ends] = len(parts) - 1
        _, offsets, data = pa.array(parts, pa.large_binary()).take(pa.array(codes)).buffers()
        stops = np.frombuffer(offsets, np.int64)[1 + ends] // 4
        return np.frombuffer(data, "<u4", int(stops[-1])), np.diff(stops, prepend=0)


def _encoder(path: str) -> Encoder:
    return held("tokens", path, lambda: Encoder(path))


def encode_ids(docs: DataFrame, tokenizer_path: str, end_id: int, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id long, n_ids long, counts binary, words binary``: each document's packed ids, ``end_id`` last.

    The ids are those the tokenizer gives for the whole text.
    """

    def run(batches):
        encoder = _encoder(tokenizer_path)
        for batch, texts in text_slices(batches, "text", rows=1_024, characters=4_000_000):
            ids, lengths = encoder.encode([t or "" for t in texts], end_id)
            sizes = simple8b.block_sizes(lengths)
            words, counts = simple8b.encode(ids, sizes)
            blocks = np.cumsum(-(-lengths // simple8b.BLOCK))
            ends = np.concatenate(([0], np.cumsum(counts)))[blocks]
            first, start, packed, listed = 0, 0, [], []
            for block, end in zip(blocks.tolist(), ends.tolist(), strict=True):
                listed.append(counts[first:block].astype("<u4").tobytes())
                packed.append(words[start:end].astype("<u8").tobytes())
                first, start = block, end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(listed, pa.binary()), pa.array(packed, pa.binary())],
                ["doc_id", "n_ids", "counts", "words"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, counts binary, words binary")


def _pack(documents: list[tuple[int, int, bytes, bytes]]) -> bytes:
    table = np.array([d[:2] for d in documents], dtype=[("doc_id", "<i8"), ("n", "<u4")])
    counts, words = b"".join(d[2] for d in documents), b"".join(d[3] for d in documents)
    head = struct.pack(HEAD, b"S8B1", len(documents), len(counts) // 4, len(words) // 8)
    return head + table.tobytes() + counts + words


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, number of ids of each, all ids) of a segment."""
    magic, documents, blocks, n_words = struct.unpack_from(HEAD, payload)
    if magic != b"S8B1":
        raise ValueError("not a token segment")
    at = struct.calcsize(HEAD)
    table = np.frombuffer(payload, [("doc_id", "<i8"), ("n", "<u4")], documents, at)
    at += table.nbytes
    counts = np.frombuffer(payload, "<u4", blocks, at).astype(np.int64)
    words = np.frombuffer(payload, "<u8", n_words, at + 4 * blocks)
    lengths = table["n"].astype(np.int64)
    return table["doc_id"], lengths, simple8b.decode(words, counts, simple8b.block_sizes(lengths))


def _bounds(docs: DataFrame, id_col: str, files: int) -> list[int]:
    """Ascending doc_ids that cut the rows into about equal files; one small row comes to the driver."""
    shares = [i / files for i in range(1, files)]
    if not shares:
        return []
    row = docs.select(F.percentile_approx(F.col(id_col).cast("long"), shares, 10_000).alias("cuts")).first()
    return sorted(set(row.cuts or []))


def write_tokens(encoded: DataFrame, path: str, bounds: list[int]) -> None:
    """Writes the rows of ``encode_ids`` below ``path``. ``bounds`` cut the doc_ids into files.

    A file takes the rows between two bounds: repeated doc_ids stay together.
    """
    from bisect import bisect_right

    key = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else None
    number = F.lit(0) if cuts is None else F.size(F.filter(cuts, lambda b: b <= key))
    rows = encoded.withColumn("file", number.cast("int"))
    rows = rows.repartitionById(len(bounds) + 1, "file").sortWithinPartitions(key, "words")

    def pack(batches):
        part, first, segment, held, size = 0, 0, 0, [], 0

        def flush():
            nonlocal first, segment, held, size
            row = pa.RecordBatch.from_pylist(
                [{"file": part, "segment": segment, "first": first, "n_ids": size, "payload": _pack(held)}],
                schema=pa.schema(
                    [("file", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]
                ),
            )
            first, segment, held, size = first + size, segment + 1, [], 0
            return row

        for batch in batches:
            for doc_id, n_ids, counts, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_id = NO_ID if doc_id is None else doc_id
                now = bisect_right(bounds, doc_id)
                if held and now != part:
                    yield flush()
                    first = segment = 0
                part = now
                held.append((doc_id, n_ids, counts, words))
                size += n_ids
                if size >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()

    rows.select("doc_id", "n_ids", "counts", "words").mapInArrow(
        pack, "file int, segment int, first long, n_ids long, payload binary"
    ).write.parquet(path)


def _segments(spark, path: str) -> DataFrame:
    """``start, payload`` of each segment of a store; ``start`` counts the ids of all documents before."""
    segments = spark.read.parquet(path)
    ordered = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = segments.groupBy("file").agg(F.sum("n_ids").alias("n"))
    # One row per file, and there are no more files than write_tokens was given bounds for.
    starts = files.select("file", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("base"))
    return segments.join(F.broadcast(starts), "file").select((F.col("base") + F.col("first")).alias("start"), "payload")


def _documents(batches):
    """(doc_ids, starts, numbers of ids, ids) of each segment."""
    for batch in batches:
        for start, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            doc_ids, sizes, ids = unpack(payload)
            names = pa.array([None if i == NO_ID else i for i in doc_ids.tolist()], pa.int64())
            yield names, pa.array(start + np.cumsum(sizes) - sizes, pa.int64()), sizes, ids


def read_tokens(spark, path: str) -> DataFrame:
    """``doc_id, start, ids array<long>`` of a store; ``start`` counts the ids of all documents before."""

    def run(batches):
        for names, starts, sizes, ids in _documents(batches):
            parts = np.split(ids.astype(np.int64), np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays([names, starts, list_array(parts, pa.int64())], ["doc_id", "start", "ids"])

    return _segments(spark, path).mapInArrow(run, "doc_id long, start long, ids array<long>")


def read_checksums(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a store; ids count as little-endian unsigned 32-bit integers."""

    def run(batches):
        for names, starts, sizes, ids in _documents(batches):
            data, stops = memoryview(ids.astype("<u4").tobytes()), (4 * np.cumsum(sizes)).tolist()
            crcs = [zlib.crc32(data[a:b]) for a, b in zip([0, *stops], stops, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [names, starts, pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return _segments(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> str:
    """Encodes and writes ``docs``; returns the store's folder, by default one in the shared folder."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_tokens(encode_ids(docs, tokenizer_path, end_id), path, _bounds(docs, "doc_id", files))
    return path
