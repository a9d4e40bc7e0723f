"""Near-duplicate documents by SimHash, found with pigeonring filtering.

Each text has a fingerprint of 64 bits. Its ``SEGMENTS`` segments stand in a ring.
If two fingerprints differ in at most ``DISTANCE`` bits, then from some segment on
the differences in the first 1, 2, 3, ... segments of the ring stay within their
proportional shares, floor(i * DISTANCE / SEGMENTS). With 7 segments and 4 bits
these are 0, 1, 1, 2, 2, 3, 4. So the first segment of such a chain is equal, one
of the next two is, and either the other one too or one of the two after them:
five patterns of three equal segments, from seven starts.

* Equal fingerprints are one class; distinct ones are listed under the values of
  their three segments for each pattern and start.
* In a list, each one is compared with a pivot, the smallest. Lists that still
  hold several components are cut finer, by the same patterns over a second order of
  the bits, and compared in blocks, only between components.
* A pair must pass the chain from its pattern's start before all bits are counted.

No list or chain is cut off: every pair within the distance shares a list of either
order, and its ends come into one component.

Nulls: a text without words has fingerprint zero, linked like any other. Rows
without a doc_id get a row each with a null component. Every row keeps its own
fingerprint; rows of one doc_id are one document, and links of any of them are its
links. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import text_slices
from ledgerlens.llm.components import connected
from ledgerlens.session import materialize

SHINGLE, SEED = 4, 42
DISTANCE, SEGMENTS = 4, 7
#: Steps from the start of a chain to its three equal segments.
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4))
#: Most fingerprints of a list that is compared as one block.
BLOCK = 2_048
#: Shingles of a text whose bits are counted at a time.
COUNTED = 65_536
#: The second order takes every seventh bit; 7 and 64 have no common factor, 3 keeps the orders apart.
STRIDE = 7

_WIDTHS = [64 // SEGMENTS + (i < 64 % SEGMENTS) for i in range(SEGMENTS)]
_STARTS = [sum(_WIDTHS[:i]) for i in range(SEGMENTS)]


def fingerprint(text: str | None) -> int:
    """Bits set in more than half of the hashes of the text's shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = np.concatenate(([0], ends[:-1])).tolist()
    size = min(SHINGLE, len(words))
    ends = (ends - 1)[size - 1 :].tolist()
    digest, count = xxhash.xxh64_intdigest, len(ends)
    totals = np.zeros(64, np.int64)
    for at in range(0, count, COUNTED):
        some = [digest(joined[a:b], SEED) for a, b in zip(begins[at : at + COUNTED], ends[at : at + COUNTED], strict=False)]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > count, bitorder="little").view("<u8")[0])


def _fingerprints(rows: DataFrame) -> DataFrame:
    """``doc, print`` of ``doc, text``."""

    def run(batches):
        for batch, texts in text_slices(batches, "text", rows=512):
            prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(prints)], ["doc", "print"])

    return rows.mapInArrow(run, "doc long, print long")


def _mask(order: list[int], segments) -> int:
    """The bits of some segments of an order of bits, as a signed long."""
    bits = [order[b] for s in segments for b in range(_STARTS[s], _STARTS[s] + _WIDTHS[s])]
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


ORDERS = [list(range(64)), [(i * STRIDE + 3) % 64 for i in range(64)]]
#: Per order the masks of each pattern from each start, and of the growing chains from that start.
LISTS = [
    [
        (
            _mask(order, [(start + step) % SEGMENTS for step in pattern]),
            [_mask(order, [(start + j) % SEGMENTS for j in range(i)]) for i in range(1, SEGMENTS + 1)],
        )
        for start in range(SEGMENTS)
        for pattern in PATTERNS
    ]
    for order in ORDERS
]
ALLOWED = [i * DISTANCE // SEGMENTS for i in range(1, SEGMENTS + 1)]


def _listed(prints: Column, order: int) -> Column:
    """Per list ``lst``: its number and the bits that its members share."""
    entries = [
        F.struct(F.lit(i).cast("short").alias("lst"), prints.bitwiseAND(F.lit(mask)).alias("bits"))
        for i, (mask, _) in enumerate(LISTS[order])
    ]
    return F.explode(F.array(*entries))


def _viable(a: Column, b: Column, lst: Column) -> Column:
    """Whether two fingerprints pass the chain of their list, the last link of which is the full count."""
    differing = a.bitwiseXOR(b)

    def within(chain: list[int]) -> Column:
        return reduce(Column.__and__, [F.bit_count(differing.bitwiseAND(F.lit(m))) <= most for m, most in zip(chain, ALLOWED, strict=True)])

    chains = [LISTS[0][start * len(PATTERNS)][1] for start in range(SEGMENTS)]
    start = F.floor(lst / len(PATTERNS))
    return reduce(lambda rest, i: F.when(start == i, within(chains[i])).otherwise(rest), range(SEGMENTS), F.lit(False))


def _chained(prints: np.ndarray, other: np.ndarray, chain: list[int]) -> np.ndarray:
    """Places in ``other`` that pass the chain from ``prints`` (one value)."""
    at = np.arange(len(other))
    for mask, most in zip(chain, ALLOWED, strict=True):
        differing = (other[at] ^ prints) & np.uint64(mask % (1 << 64))
        at = at[np.bitwise_count(differing) <= most]
        if not len(at):
            break
    return at


def _pairs(left, right, same: bool, chain: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Linked (node, node) between two blocks of a list: per node and other component one link is enough."""

    def side(block):
        return (block.field(c).to_numpy() for c in ("node", "print", "component"))

    node, prints, own = side(left)
    other, others, far = (node, prints, own) if same else side(right)
    prints, others = prints.view(np.uint64), others.view(np.uint64)
    a, b = [], []
    for i in range(len(node)):
        apart = np.flatnonzero(far[i + 1 if same else 0 :] != own[i]) + (i + 1 if same else 0)
        at = apart[_chained(prints[i], others[apart], chain)] if len(apart) else apart
        if len(at):
            at = at[np.unique(far[at], return_index=True)[1]]
            a.append(np.full(len(at), node[i]))
            b.append(other[at])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(a or empty), np.concatenate(b or empty)


def _compared(members: DataFrame, keys: list[str], order: int) -> DataFrame:
    """``a, b``: links in the lists ``keys`` of ``node, print, component`` between different components."""
    parts = members.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    dealt = members.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    blocks = dealt.groupBy(*keys, "parts", "part").agg(F.collect_list(F.struct("node", "print", "component")).alias("items"))
    blocks = materialize(blocks, "blocks")
    many = blocks.where("parts > 1")
    second = many.select(*keys, F.col("part").alias("part2"), F.col("items").alias("items2"))
    both = many.join(second, keys).where(F.col("part") < F.col("part2")).select("lst", "items", "items2")
    chains = [chain for _, chain in LISTS[order]]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                left = one.column("items").flatten()
                right = one.column("items2").flatten() if "items2" in batch.schema.names else None
                found = _pairs(left, right, right is None, chains[one.column("lst")[0].as_py()])
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["a", "b"])

    alone = blocks.select("lst", "items").mapInArrow(run, "a long, b long")
    return alone.union(both.mapInArrow(run, "a long, b long"))


def _open(members: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Members of the lists of ``least`` and more that hold several components, with the size of the list."""
    several = members.groupBy(*keys).agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    several = several.where((F.col("low") < F.col("high")) & (F.col("size") >= least)).select(*keys, "size")
    return members.hint("merge").join(several, keys)


def _named(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, print, component`` with the components of ``links``."""
    reached = connected(links).withColumnRenamed("component", "reached")
    joined = nodes.join(reached, "node", "left")
    return joined.select("node", "print", F.coalesce("reached", "node").alias("component"))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    found = materialize(_fingerprints(rows), "prints")
    # A class of equal fingerprints is a node, named by its smallest document.
    nodes = found.where("doc is not null").groupBy("print").agg(F.min("doc").alias("node"))
    nodes = materialize(nodes, "nodes")

    keys = ["lst", "bits"]
    # Spark reckons the lists by the size of the nodes, which they are 35 times as many as: no side is to be broadcast.
    members = nodes.select("node", "print", _listed(F.col("print"), 0).alias("e")).select("node", "print", "e.*")
    pivots = members.groupBy(*keys).agg(F.min(F.struct("node", "print")).alias("p"), F.count("*").alias("size"))
    met = materialize(members.hint("merge").join(pivots.where("size > 1"), keys).select(*keys, "node", "print", "p"), "lists")
    near = met.where((F.col("node") != F.col("p.node")) & _viable(F.col("print"), F.col("p.print"), F.col("lst")))
    links = near.select(F.col("p.node").alias("a"), F.col("node").alias("b"))
    # Documents whose rows have several fingerprints tie the classes of these together.
    twice = found.where("doc is not null").groupBy("doc").agg(F.min("print").alias("x"), F.max("print").alias("y"))
    tied = found.join(twice.where("x <> y").select("doc"), "doc").distinct().join(nodes, "print").where("doc <> node")
    links = links.distinct().union(tied.select(F.col("node").alias("a"), F.col("doc").alias("b")))
    links = materialize(links, "links")

    placed = _named(nodes, links)
    open_ = met.select(*keys, "node", "print").hint("merge").join(placed.select("node", "component").distinct(), "node")
    open_ = materialize(_open(open_, keys, least=3), "open")  # of two members one is the pivot
    finer = ["first", "bits", "lst", "bits2"]
    large = open_.where(F.col("size") > BLOCK).drop("size").withColumnRenamed("lst", "first")
    large = large.select("first", "bits", "node", "print", "component", _listed(F.col("print"), 1).alias("e"))
    large = large.select("first", "bits", F.col("e.lst").alias("lst"), F.col("e.bits").alias("bits2"), "node", "print", "component")
    large = _open(large, finer).drop("size")
    more = _compared(open_.where(F.col("size") <= BLOCK).drop("size"), keys, 0).union(_compared(large, finer, 1))
    links = links.union(more.distinct())

    reached = connected(links)
    named = nodes.join(reached, "node", "left").select("print", F.coalesce("component", "node").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    known = found.where("doc is not null").join(named, "print")
    nameless = found.where("doc is null").withColumn("component_id", F.lit(None).cast("long"))
    columns = [F.col("doc").alias(id_col), hexed, "component_id"]
    return known.select(*columns).union(nameless.select(*columns))
