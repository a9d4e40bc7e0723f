"""Hard negatives: for an anchor and each of its positives, the best rows of other labels within a window of scores.

Candidates of one label are put in the order of a Hilbert curve and stored as
Parquet in blocks of about ``BLOCK_ROWS``; each block row carries its zone map, the
least and greatest value of every dimension and the greatest length. Interval
arithmetic over a zone map bounds the products that an anchor can have with the
rows of the block, from both sides. A search goes over the blocks in passes:

* first each anchor reads, of the blocks that its windows may hold, those with the
  highest bounds until they hold ``FIRST_ROWS`` rows, chosen by the zone maps alone;
  the scores found there raise the lower ends of windows that are already full;
* among many blocks a part of them, and then a greater one, raises them further;
* then it reads every block whose bounds meet one of its windows.

A task of the later passes holds some blocks of anchors and reads its blocks of rows
one by one. What it finds raises the windows too, and only the best of each window
leave it; no pairs of anchors and blocks are stored.

Positives are found the same way, with one open window among blocks of the anchor's
label. The curve runs over the ``CURVE_DIMS`` dimensions of greatest variance.

Nulls: rows whose id, label or vector is null, or whose vector is empty or has a
null or non-finite component, take no part. Shorter vectors count as ending in
zeros. Repeated rows are one; rows that share an id but not label and vector are
anchors and candidates of their own, though not of each other. Ties go to the smaller id. An anchor without positives, or
a window without rows, gives no rows. Products are exact while below 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.vector_blocks import FEW, Tops, edges, matrix, paired, parts_of, query_blocks, same_width
from ledgerlens.session import materialize

BLOCK_ROWS, ASKED_ROWS, ZONES = 1_024, 1_024, 1_024
FIRST_ROWS, PART_ROWS = 1_024, 65_536
CURVE_DIMS, CURVE_BITS = 8, 8
#: Beyond every id.
NO_LAST = 2**63 - 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (rows, dimensions), whole numbers of ``bits`` bits.

    The coordinates are turned into the transposed position bit by bit (exchanges
    and reversals from the top bit down, then a Gray code), and its bits are interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for d in range(dims):
            above = (x[d] & bit) != 0
            swap = np.where(above, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] ^= np.where(above, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    position = np.zeros_like(x[0])
    for level in reversed(range(bits)):
        for d in range(dims):
            position = (position << np.uint64(1)) | ((x[d] >> np.uint64(level)) & np.uint64(1))
    return position


def usable(rows: DataFrame, label: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, label, v array<double>`` of the distinct rows that take part; components are floor(scale * x)."""
    found = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector_col}`").alias("v"))
    found = found.where("id is not null and label is not null and v is not null and size(v) > 0")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    exact = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return found.where(~odd).withColumn("v", exact).distinct()


def _curve(vectors: DataFrame) -> list[tuple[int, float, float]]:
    """Dimension, middle and spread of those of greatest variance: one row per dimension reaches the driver."""
    parts = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    best = parts.orderBy(F.col("s").desc(), "d").limit(CURVE_DIMS).collect()
    return [(r["d"], r["m"], r["s"] or 1.0) for r in best]


def _placed(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``place``, the position on the curve."""
    curve = _curve(vectors)
    top = (1 << CURVE_BITS) - 1

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column("v"))
            wide = np.pad(values, ((0, 0), (0, max(0, 1 + max(d for d, _, _ in curve) - values.shape[1]))))
            # Three spreads to each side; what lies beyond shares the outermost cell.
            cells = np.stack([np.clip((wide[:, d] - m) / (6 * s) + 0.5, 0, 1) * top for d, m, s in curve], axis=1)
            place = hilbert(cells.astype(np.uint64), CURVE_BITS) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place.view(np.int64))], [*batch.schema.names, "place"])

    return vectors.select("id", "label", "v").mapInArrow(run, "id long, label long, v array<double>, place long")


def candidate_blocks(vectors: DataFrame) -> DataFrame:
    """``block, label, size, low, high, longest, items``: stored blocks of one label in the order of the curve."""
    ordered = _placed(vectors).repartitionByRange("label", "place", "id").sortWithinPartitions("label", "place", "id")

    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            for start, stop in zip(edges, edges[1:], strict=False):
                parts = -(-(stop - start) // BLOCK_ROWS)
                for i in range(parts):
                    a, b = start + (stop - start) * i // parts, start + (stop - start) * (i + 1) // parts
                    some = batch.slice(a, b - a)
                    values = matrix(some.column("v"))
                    items = pa.StructArray.from_arrays([some.column("id"), some.column("v")], ["id", "v"])
                    whole = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), items)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(labels[a])]),
                            pa.array([b - a], pa.int64()),
                            pa.array([values.min(axis=0).tolist()], pa.list_(pa.float64())),
                            pa.array([values.max(axis=0).tolist()], pa.list_(pa.float64())),
                            pa.array([float(np.sqrt((values * values).sum(axis=1)).max())]),
                            whole,
                        ],
                        ["label", "size", "low", "high", "longest", "items"],
                    )

    schema = "label long, size long, low array<double>, high array<double>, longest double, items array<struct<id: long, v: array<double>>>"
    blocks = ordered.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())
    return materialize(blocks, "hilbert-blocks", **FEW)


def bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, blocks): least and greatest product that a row of the block can have with the anchor."""
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    # No product exceeds that of the lengths; the slack is for their rounding.
    reach = np.sqrt((asked * asked).sum(axis=1))[:, None] * longest[None, :] * (1 + 1e-9) + 1e-6
    return np.maximum(least, -reach), np.minimum(most, reach)


class Asked:
    """A block of anchors with the ends of their windows, a column each, and the best rows found for each window."""

    def __init__(self, who: pa.StructArray, count: int):
        self.key, self.id, self.label = (who.field(c).to_numpy().copy() for c in ("key", "id", "label"))
        self.v, self.count = matrix(who.field("v")), count
        windows = who.field("windows")
        sizes = windows.value_lengths().to_numpy()
        flat = windows.flatten()
        there = np.arange(int(sizes.max(initial=0)))[None, :] < sizes[:, None]

        def column(name: str, absent) -> np.ndarray:
            out = np.full(there.shape, absent)
            out[there] = flat.field(name).to_numpy()
            return out

        # A window that is not there holds nothing.
        self.w, self.low, self.high, self.last = column("w", 0), column("low", np.inf), column("high", -np.inf), column("last", 0)
        self.best = Tops(there.size, count)

    def read(self, at: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        """Looks up the rows of a block for the anchors at ``at``; a full window begins at its last row from then on."""
        mine, values = same_width(self.v[at], values)
        scores = mine @ values.T
        width = self.low.shape[1]
        for w in range(width):
            fits = (scores >= self.low[at, w, None]) & (scores <= self.high[at, w, None])
            if np.count_nonzero(fits) > 4 * self.count * len(at):
                # Rows of the anchor's own id are none of the best.
                fits &= ids[None, :] != self.id[at, None]
                fits &= scores >= edges(np.where(fits, scores, -np.inf), self.count)[:, None]
            k, place = np.nonzero(fits)
            i, row, who = at[k], scores[k, place], ids[place]
            keep = ((row > self.low[i, w]) | (who <= self.last[i, w])) & (who != self.id[i])
            if keep.any():
                full = self.best.add(i[keep] * width + w, row[keep], who[keep])
                self.low.flat[full], self.last.flat[full] = self.best.scores[full, -1], self.best.ids[full, -1]

    def rows(self) -> pa.RecordBatch:
        search, place = np.nonzero(self.best.scores > -np.inf)
        i = search // max(1, self.low.shape[1])
        flat = [self.key[i], self.w.flat[search], self.best.scores[search, place].astype(np.int64), self.best.ids[search, place]]
        return pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in flat], ["key", "w", "score", "id"])


FOUND = "key long, w long, score long, id long"
ZONE = ["block", "label", "size", "low", "high", "longest"]


def _reached(asked: Asked, zones: pa.StructArray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, blocks): whether a block may have rows in one of the anchor's windows, and its upper bound."""
    low, high = same_width(matrix(zones.field("low")), matrix(zones.field("high")))
    values, low = same_width(asked.v, low)
    values, high = same_width(values, high)
    least, most = bounds(values, low, high, zones.field("longest").to_numpy())
    fits = (asked.label[:, None] == zones.field("label").to_numpy()[None, :]) == same
    met = np.zeros(fits.shape, bool)
    for w in range(asked.low.shape[1]):
        met |= (most >= asked.low[:, w, None]) & (least <= asked.high[:, w, None])
    return fits & met, most


def _nearest(asked: DataFrame, held: DataFrame, same: bool, count: int) -> DataFrame:
    """``key, block``: of each anchor the blocks of highest bounds until they hold ``FIRST_ROWS`` rows."""
    zones = held.select(*ZONE)
    groups = max(1, -(-zones.count() // ZONES))
    grouped = zones.groupBy(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("zgroup")).agg(F.collect_list(F.struct(*ZONE)).alias("zones"))
    grouped = materialize(grouped, "zones")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                who, where = Asked(one.column("asked").flatten(), count), one.column("zones").flatten()
                met, most = _reached(who, where, same)
                blocks, sizes = where.field("block").to_numpy(), where.field("size").to_numpy()
                most = np.where(met, most, -np.inf)
                order = np.lexsort((np.broadcast_to(blocks, most.shape), -most), axis=1)
                met = np.take_along_axis(met, order, axis=1)
                held = np.where(met, sizes[order], 0)
                a, z = np.nonzero(met & (np.cumsum(held, axis=1) - held < FIRST_ROWS))
                z = order[a, z]
                columns = [who.key[a], blocks[z], sizes[z], most[a, z]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "block", "size", "most"])

    found = paired(asked, grouped).select("asked", "zones").mapInArrow(run, "key long, block long, size long, most double")
    order = Window.partitionBy("key").orderBy(F.col("most").desc(), "block")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("before", before).where(F.coalesce("before", F.lit(0)) < FIRST_ROWS).select("key", "block")


def _first(anchors: DataFrame, held: DataFrame, near: DataFrame, count: int) -> DataFrame:
    """``key, w, score, id``: the best rows of the blocks that each anchor is ``near``; anchors are sent to their blocks."""
    near = materialize(near, "near")
    parts = near.groupBy("block").agg(F.ceil(F.count("*") / ASKED_ROWS).cast("int").alias("parts"))
    anchor = F.struct("key", "id", "label", "v", "windows")
    sent = near.join(parts, "block").join(anchors.select("key", anchor.alias("a")), "key")
    sent = sent.groupBy("block", F.pmod(F.xxhash64("key"), F.col("parts")).alias("part")).agg(F.collect_list("a").alias("asked"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                who, items = Asked(one.column("asked").flatten(), count), one.column("items").flatten()
                who.read(np.arange(len(who.key)), matrix(items.field("v")), items.field("id").to_numpy())
                yield who.rows()

    # The blocks move once; their partners are the small side, and too many for a broadcast.
    return held.select("block", "items").join(sent.hint("shuffle_hash"), "block").select("items", "asked").mapInArrow(run, FOUND)


def _met(asked: DataFrame, held: DataFrame, same: bool, count: int) -> DataFrame:
    """``key, w, score, id``: per anchor and window the ``count`` best rows of the blocks of one task."""

    def run(batches):
        at_hand: dict[int, Asked] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                name = one.column("ablock")[0].as_py()
                if name not in at_hand:
                    at_hand[name] = Asked(one.column("asked").flatten(), count)
                who, where = at_hand[name], pa.StructArray.from_arrays([one.column(c) for c in ZONE], ZONE)
                at = np.flatnonzero(_reached(who, where, same)[0][:, 0])
                if len(at):
                    items = one.column("items").flatten()
                    who.read(at, matrix(items.field("v")), items.field("id").to_numpy())
        for who in at_hand.values():
            yield who.rows()

    met = paired(asked.withColumnRenamed("block", "ablock"), held)
    return met.select(*ZONE, "items", "ablock", "asked").mapInArrow(run, FOUND)


def _asked(anchors: DataFrame) -> DataFrame:
    """``block, asked``: anchors in blocks."""
    return query_blocks(anchors, ["key", "id", "label", "v", "windows"], ASKED_ROWS, "key")


def _raised(anchors: DataFrame, seen: DataFrame, count: int) -> DataFrame:
    """``anchors`` with windows that begin at their last place, where ``seen`` fills them."""
    # The last row of a full window is one that its last place cannot fall behind: neither in score nor, at a tie, in id.
    place = F.row_number().over(Window.partitionBy("key", "w").orderBy(F.col("score").desc(), "id"))
    full = seen.withColumn("place", place).where(F.col("place") <= count).where(F.col("place") == count)
    entry = F.struct("w", F.struct(F.col("score").cast("double").alias("low"), F.col("id").alias("last")))
    raised = materialize(full.groupBy("key").agg(F.map_from_entries(F.collect_list(entry)).alias("raised")), "raised")

    def narrowed(x: Column) -> Column:
        to = F.try_element_at("raised", x["w"])
        low, end = F.coalesce(to["low"], x["low"]), F.coalesce(to["last"], x["last"])
        return F.struct(x["w"].alias("w"), low.alias("low"), x["high"].alias("high"), end.alias("last"))

    known = anchors.join(raised, "key", "left")
    return known.select("key", "id", "label", "v", F.transform("windows", narrowed).alias("windows"))


def windowed_best(anchors: DataFrame, held: DataFrame, same: bool, count: int) -> DataFrame:
    """``key, w, rank, score, id``: the ``count`` best rows in each window of each anchor.

    ``anchors``: ``key, id, label, v, windows array<struct<w long, low double, high double, last long>>``, where
    rows at the low end count up to the id ``last``;
    ``held``: candidate blocks, of which those of the anchor's label are searched if ``same``, else the others.
    """
    total = held.agg(F.sum("size")).first()[0] or 0
    known = _raised(anchors, _first(anchors, held, _nearest(_asked(anchors), held, same, count), count), count)
    for wanted in parts_of(total, PART_ROWS):
        part = materialize(held.where(F.pmod(F.xxhash64("block"), F.lit(1 << 20)) < F.lit((wanted << 20) // total)), "part", **FEW)
        known = _raised(known, _met(_asked(known), part, same, count), count)
    found = _met(_asked(known), held, same, count)
    place = F.row_number().over(Window.partitionBy("key", "w").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= count).select("key", "w", "rank", "score", "id")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows where ``is_anchor`` (of column ``id``). A positive is one of an
    anchor's best rows of its own label; its negatives are the best rows of other labels
    whose scores are between ``window`` hundredths of the positive's.
    """
    vectors = usable(rows, label, scale, id_col, vector_col)
    vectors = materialize(vectors.withColumn("key", F.monotonically_increasing_id()), "vectors")
    held = candidate_blocks(vectors)
    anchors = vectors.where(is_anchor)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("w"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(NO_LAST).alias("last")))
    best = windowed_best(anchors.withColumn("windows", everything), held, True, positives)
    best = materialize(best.select("key", F.col("rank").cast("long").alias("w"), "score", "id"), "positives")

    low, high = window
    # With a score below zero the upper end lies under the lower one and nothing fits.
    ends = F.struct("w", F.expr(f"cast(({low} * score + 99) div 100 as double)").alias("low"), F.expr(f"cast(({high} * score) div 100 as double)").alias("high"), F.lit(NO_LAST).alias("last"))
    windows = best.where("score >= 0").groupBy("key").agg(F.collect_list(ends).alias("windows"))
    wanted = anchors.join(windows, "key").select("key", "id", "label", "v", "windows")
    worst = windowed_best(materialize(wanted, "wanted"), held, False, negatives).withColumnRenamed("score", "negative_score").withColumnRenamed("id", "negative_id")
    named = best.select("key", "w", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    found = worst.join(named, ["key", "w"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
