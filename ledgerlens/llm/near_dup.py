"""Near-duplicate documents by MinHash.

Sets of five-word shingles are sketched by fast similarity sketching, cut into
bands, and documents that share a band are compared on their full sets.

* Equal sets are one class, found by fingerprint; only its representative goes on.
* Each document is compared with one pivot, the smallest document of its band
  buckets, and then, in buckets that hold several components, with a pivot drawn
  for each bucket. Links make components; most buckets then hold one and are done.
* The other buckets are cut into blocks. A task takes two blocks of a bucket and
  compares sketches of documents in different components, each pair at the first
  band it shares. Pairs that sketches do not rule out are verified on full sets.

A pair at similarity 0.75 shares no band with a chance of 2e-6 (``BANDS`` of
``ROWS`` coordinates), less for closer pairs; a sketch rules out a pair only from
six standard deviations below. Nothing is capped.

Nulls: a null text, or one without words, has an empty set and is linked with
nothing. Rows without a doc_id get a row each with a null component and are kept.
Repeated rows of one doc_id are one document; which copy counts for its set is
decided by the smallest fingerprint.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import list_array, text_slices
from ledgerlens.llm.components import connected
from ledgerlens.llm.memo import enter
from ledgerlens.llm.shingles import band_keys, shingle_set, sketch
from ledgerlens.session import materialize

THRESHOLD = (75, 100)
SHINGLE, BANDS, ROWS = 5, 48, 5
#: Documents in a block of a bucket, and bits of the sketches that are compared.
BLOCK, COMPARED = 256, 4_096


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc, n, print, keys`` of ``doc, text``."""

    def run(batches):
        enter("near_dup")
        for batch, texts in text_slices(batches, "text", rows=512):
            sizes, prints, keys = [], [], []
            for text in texts:
                members = shingle_set(text, SHINGLE)
                sizes.append(len(members))
                if len(members):
                    prints.append(xxhash.xxh3_128_digest(members.tobytes()))
                    keys.append(band_keys(sketch(members, BANDS * ROWS), BANDS, ROWS).view(np.int64))
                else:
                    prints.append(None)
                    keys.append(np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    list_array(keys, pa.int64()),
                ],
                ["doc", "n", "print", "keys"],
            )

    return docs.mapInArrow(run, "doc long, n long, print binary, keys array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """``doc, print, members, bits``: sorted hashes of 8 bytes, and one bit for each of ``COMPARED`` coordinates."""

    def run(batches):
        enter("near_dup")
        for batch, texts in text_slices(batches, "text", rows=512):
            sets = [shingle_set(t, SHINGLE) for t in texts]
            prints = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            coords = [(sketch(s, COMPARED) & np.uint64(1)).astype(np.uint8) if len(s) else np.zeros(COMPARED, np.uint8) for s in sets]
            bits = pa.array([np.packbits(c).tobytes() for c in coords], pa.binary())
            members = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), prints, members, bits], ["doc", "print", "members", "bits"])

    return docs.mapInArrow(run, "doc long, print binary, members binary, bits binary")


def _short(keys):
    """Four bytes of each band key, end to end."""
    return F.unhex(F.array_join(F.transform(keys, lambda k: F.lpad(F.hex(k.bitwiseAND(0xFFFFFFFF)), 8, "0")), ""))


def _fits(n: str, m: str):
    """Sizes that allow a link."""
    num, den = THRESHOLD
    return F.least(n, m) * den >= F.greatest(n, m) * num


def _least_agreement() -> float:
    """Fewest equal bits that do not rule out a link: six standard deviations below the mean at the threshold."""
    equal = (1 + THRESHOLD[0] / THRESHOLD[1]) / 2
    return COMPARED * equal - 6 * math.sqrt(COMPARED * equal * (1 - equal))


def _ends(pairs: DataFrame, sets: DataFrame, value: str) -> DataFrame:
    """``a, b`` with a value of both; either join may be split at a hot document."""
    left, right = (sets.select(F.col("doc").alias(c), F.col(value).alias(f"v{c}")) for c in "ab")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "va", "vb")


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sketches do not rule out a link."""
    least = _least_agreement()

    def run(batches):
        enter("near_dup")
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, COMPARED // 64) for c in ("va", "vb"))
                keep = pa.array(COMPARED - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return _ends(pairs, sets, "bits").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    num, den = THRESHOLD

    def run(batches):
        enter("near_dup")
        for batch in batches:
            keep = []
            for va, vb in zip(batch.column("va").to_pylist(), batch.column("vb").to_pylist(), strict=True):
                x, y = np.frombuffer(va, dtype=np.uint64), np.frombuffer(vb, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * common >= num * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return _ends(pairs, sets, "members").mapInArrow(run, "a long, b long")


def _survivors(left, right, same: bool, band: int) -> list[np.ndarray]:
    """(doc of left, doc of right) of pairs between two blocks of a bucket that may be links."""
    num, den = THRESHOLD
    least = _least_agreement()

    def side(block):
        doc, n, component = (block.field(c).to_numpy() for c in ("doc", "n", "component"))
        bits = np.frombuffer(b"".join(block.field("bits").to_pylist()), np.uint64).reshape(len(n), -1)
        keys = np.frombuffer(b"".join(block.field("short").to_pylist()), np.uint32).reshape(len(n), BANDS)
        return doc, n, component, bits, keys

    doc, n, own, bits, keys = side(left)
    other, m, far, other_bits, other_keys = (doc, n, own, bits, keys) if same else side(right)
    found = []
    for i in range(len(n)):
        fits = (far != own[i]) & (den * np.minimum(m, n[i]) >= num * np.maximum(m, n[i]))
        if same:
            fits[: i + 1] = False
        at = np.flatnonzero(fits)
        at = at[COMPARED - np.bitwise_count(other_bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64) >= least]
        at = at[~(other_keys[at, :band] == keys[i, :band]).any(axis=1)]
        if len(at):
            found.append(np.stack((np.full(len(at), doc[i]), other[at])))
    return list(np.concatenate(found, axis=1)) if found else [np.zeros(0, np.int64)] * 2


def _apart(open_: DataFrame, payload: DataFrame) -> DataFrame:
    """``a, b``: pairs in one bucket of ``open_`` (``key, band, doc, n, component``) but in two components that may be links."""
    parts = open_.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    dealt = open_.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")))
    item = F.struct("doc", "n", "component", "bits", "short")
    blocks = dealt.join(payload, "doc").groupBy("key", "band", "parts", "part").agg(F.collect_list(item).alias("items"))
    blocks = materialize(blocks, "blocks")
    many = blocks.where("parts > 1")
    other = many.select("key", F.col("part").alias("part2"), F.col("items").alias("items2"))
    both = many.join(other, "key").where(F.col("part") < F.col("part2")).select("band", "items", "items2")

    def run(batches):
        enter("near_dup")
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                left = part.column("items").flatten()
                right = part.column("items2").flatten() if "items2" in batch.schema.names else None
                found = _survivors(left, right, right is None, part.column("band")[0].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["a", "b"])

    return blocks.select("band", "items").mapInArrow(run, "a long, b long").union(both.mapInArrow(run, "a long, b long"))


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``key, band, doc, n, component`` after further links between documents."""
    own = placed.select("doc", "component").distinct()
    ends = links.join(own.select(F.col("doc").alias("a"), F.col("component").alias("x")), "a")
    ends = ends.join(own.select(F.col("doc").alias("b"), F.col("component").alias("y")), "b")
    over = connected(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    over = over.select(F.col("node").alias("component"), F.col("component").alias("final"))
    return placed.join(over, "component", "left").select("key", "band", "doc", "n", F.coalesce("final", "component").alias("component"))


def _open(placed: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(mixed.where("low < high").select("key"), "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept``: one row per document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    found = materialize(_sketches(rows), "sketches")
    slim = found.select("doc", "n", "print").where("doc is not null")
    # One set per doc_id, whatever the number of its rows.
    slim = slim.groupBy("doc").agg(F.min(F.struct("print", "n")).alias("s")).select("doc", "s.n", "s.print")
    classes = slim.where("n > 0").groupBy("print").agg(F.min("doc").alias("rep"))
    slim, classes = materialize(slim, "documents"), materialize(classes, "classes")

    key = [F.col("doc") == F.col("rep"), found["print"] == classes["print"]]
    reps = found.join(classes, key).select("doc", "n", "keys").dropDuplicates(["doc"])
    bands = reps.select("doc", "n", F.posexplode("keys").alias("band", "key"))
    crowded = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    members = materialize(bands.join(crowded, "key"), "members")

    wanted = members.select("doc").distinct()
    chosen = wanted.join(classes, F.col("doc") == F.col("rep")).select("doc", "print")
    texts = rows.join(chosen.select("doc"), "doc", "left_semi")
    sets = materialize(_sets(texts).join(chosen, ["doc", "print"]).dropDuplicates(["doc"]), "sets")

    first = members.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("p"))
    met = members.join(first, "key").where((F.col("doc") > F.col("p.doc")) & _fits("n", "p.n"))
    pairs = met.groupBy(F.col("doc").alias("b")).agg(F.min("p.doc").alias("a"))
    components = connected(_linked(pairs, sets))

    named = components.select(F.col("node").alias("doc"), "component")
    placed = members.join(named, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    placed = materialize(placed.select("key", "band", "doc", "n", "component"), "placed")

    open_ = materialize(_open(placed), "open")
    draw = F.struct(F.xxhash64("doc", "key").alias("o"), "doc", "n", "component")
    pivots = open_.groupBy("key").agg(F.min(draw).alias("p"))
    met = open_.join(pivots, "key").where((F.col("component") != F.col("p.component")) & _fits("n", "p.n"))
    pairs = met.select(F.least("doc", "p.doc").alias("a"), F.greatest("doc", "p.doc").alias("b")).distinct()
    placed = materialize(_merged(placed, _linked(_likely(pairs, sets), sets)), "placed")

    keys = found.join(chosen, ["doc", "print"]).dropDuplicates(["doc"]).select("doc", _short(F.col("keys")).alias("short"))
    payload = sets.select("doc", "bits").join(keys, "doc")
    placed = _merged(placed, _linked(_apart(_open(placed), payload), sets))
    components = placed.select(F.col("doc").alias("node"), "component").distinct()

    reached = components.select(F.col("node").alias("rep"), "component")
    named = classes.join(reached, "rep", "left").select("print", F.coalesce("component", "rep").alias("component"))
    result = slim.join(named, "print", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
    nameless = found.where("doc is null").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    kept = F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    return result.union(nameless).withColumn("kept", kept)
