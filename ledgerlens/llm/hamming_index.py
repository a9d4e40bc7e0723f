"""Approximate nearest neighbours by multi-index hashing.

Unit vectors are turned by a learned rotation (principal axes, then iterative
quantisation) and keep one bit per axis. A code is split into substrings, and
each block of codes is indexed by each substring. Two codes within ``radius``
bits agree in some substring up to ``radius // substrings`` bits, so probing all
values that near, in every substring, finds every code within the radius; where
that is more values than a block has codes, its codes are compared instead. Those
found are ranked by the exact cosine of the original vectors.

Rotation and radius come from at most ``SAMPLE`` vectors (by hash of the id);
every vector is indexed. The radius is the distance within which ``COVERED`` of
the sample's true neighbours lie; among more vectors neighbours are nearer. A
query that finds too few (an outlier among tight groups) is searched again among
all codes, so fewer come back only if there are no more.

Nulls: rows whose id or vector is null, or whose vector is zero, empty or has a
null or non-finite component, take no part. Shorter vectors count as ending in
zeros. Repeated rows are one; equal vectors under other ids each rank, ties to
smaller ids.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.vector_blocks import Ids, asked_of, blocks, classes, edges, matrix, ranked, same_width, top_found, usable
from ledgerlens.session import materialize

SAMPLE, COVERED = 10_000, 0.97
BITS, PARTS = 64, 4
#: Queries that are compared with a block at a time.
COMPARED = 256


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


class Codes:
    """A fitted hash: ``turn`` maps unit vectors to signed axes, ``radius`` is the first search radius."""

    def __init__(self, turn: np.ndarray, radius: int):
        self.turn, self.radius = turn, radius

    def of(self, unit: np.ndarray) -> np.ndarray:
        unit, turn = same_width(unit, self.turn.T)
        bits = (unit @ turn.T) > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def fit(sample: np.ndarray, neighbours: int, rounds: int = 20, covered: float = COVERED, seed: int = 7) -> Codes:
    """Learns rotation and radius from unit vectors."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    values, axes = np.linalg.eigh(sample.T @ sample)
    axes = axes[:, np.argsort(-values)][:, : min(width, BITS)]
    turns, bits = [], 0
    while bits < BITS:  # narrow vectors get several rotations
        turned = sample @ axes
        rotation = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(turned @ rotation).T @ turned)
            rotation = (left @ right).T
        turns.append(axes @ rotation)
        bits += axes.shape[1]
    codes = Codes(np.hstack(turns)[:, :BITS], BITS)
    all_codes = codes.of(sample)
    asked = rng.permutation(len(sample))[:300]
    cosines = sample[asked] @ sample.T
    cosines[np.arange(len(asked)), asked] = -2
    near = np.argsort(-cosines, axis=1)[:, : min(neighbours, len(sample) - 1)]
    distances = np.bitwise_count(all_codes[asked][:, None] ^ all_codes[near])
    if distances.size:
        codes.radius = int(np.quantile(distances, covered, method="higher"))
    return codes


def _probes(bits: int, near: int) -> int:
    """How many values of ``bits`` bits differ from a given one in at most ``near``."""
    return sum(comb(bits, r) for r in range(min(near, bits) + 1))


def _masks(bits: int, radius: int) -> np.ndarray:
    """All values of ``bits`` bits with at most ``radius`` ones."""
    return np.array(
        [sum(1 << b for b in chosen) for r in range(min(radius, bits) + 1) for chosen in combinations(range(bits), r)],
        dtype=np.int64,
    )


class MultiIndex:
    """Codes indexed by each of their substrings."""

    def __init__(self, codes: np.ndarray, radius: int, parts: int = PARTS):
        self.codes, self.radius, self.bits = codes, radius, BITS // parts
        self.near = radius // parts
        self.probes = _probes(self.bits, self.near)
        self.tables = []
        for part in range(parts):
            values = self._part(codes, part)
            order = np.argsort(values, kind="stable")
            found, starts = np.unique(values[order], return_index=True)
            self.tables.append((found, np.append(starts, len(values)), order))
        self.masks = None

    def _part(self, codes, part: int):
        return ((codes >> np.uint64(part * self.bits)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def within(self, code: np.uint64) -> np.ndarray:
        """Places of all codes within the radius."""
        if self.radius >= BITS:
            return np.arange(len(self.codes))
        met = np.zeros(len(self.codes), dtype=bool)
        for part, (found, starts, order) in enumerate(self.tables):
            wanted = int(self._part(code, part))
            hit = np.flatnonzero(self._probed(found, wanted))
            for a, b in _runs(starts[hit], starts[hit + 1]):
                met[order[a:b]] = True
        place = np.flatnonzero(met)
        return place[np.bitwise_count(self.codes[place] ^ code) <= self.radius]

    def _probed(self, found: np.ndarray, wanted: int) -> np.ndarray:
        """Which of the values that occur are near the wanted one: by probing, or by a walk if fewer occur."""
        if self.probes < len(found):
            if self.masks is None:
                self.masks = _masks(self.bits, self.near)
            probes = self.masks ^ wanted
            at = np.minimum(np.searchsorted(found, probes), len(found) - 1)
            hit = np.zeros(len(found), dtype=bool)
            hit[at[found[at] == probes]] = True
            return hit
        return np.bitwise_count(found ^ wanted) <= self.near


def _runs(starts: np.ndarray, stops: np.ndarray):
    """Joins touching ranges."""
    if not len(starts):
        return []
    new = np.flatnonzero(starts[1:] != stops[:-1]) + 1
    return zip(starts[np.concatenate(([0], new))].tolist(), stops[np.concatenate((new - 1, [len(stops) - 1]))].tolist(), strict=True)


def _indexed(items, codes: Codes, radius: int):
    """A block's vectors with lengths, directions and codes, and the index of these if probing it takes less than comparing all."""
    c = matrix(items.field("v"))
    unit = _unit(c)
    found = codes.of(unit)
    probed = radius < BITS and _probes(BITS // PARTS, radius // PARTS) < len(found)
    lengths = np.sqrt((c * c).sum(axis=1))
    return c, lengths, unit.astype(np.float32), found, MultiIndex(found, radius) if probed else None, Ids(items)


def _nearest(asked, block, bounds: np.ndarray, codes: Codes, radius: int, count: int):
    """Yields the queries' best of one block among the codes within the radius, none below its known bound."""
    c, lengths, directions, found, index, ids = block
    q = matrix(asked.field("v"))
    unit = _unit(q)
    q_codes = codes.of(unit)
    q, c = same_width(q, c)
    towards, directions = same_width(unit.astype(np.float32), directions)
    sizes = np.sqrt((q * q).sum(axis=1))
    # Twice what single precision may be off by.
    slack = 2.4e-7 * (c.shape[1] + 8)
    for start in range(0, len(q), COMPARED):
        some = np.arange(start, min(start + COMPARED, len(q)))
        least = bounds[some] - slack
        known = ~np.isnan(least)
        if index is not None:
            met = [index.within(code) for code in q_codes[some]]
            rows, place = np.repeat(np.arange(len(some)), [len(m) for m in met]), np.concatenate(met)
        else:
            rough = (towards[some] @ directions.T).astype(np.float32, copy=False)
            if not known.all():
                far = np.bitwise_count(q_codes[some[~known], None] ^ found[None, :]) > radius
                some_rough = np.where(far, np.float32(-np.inf), rough[~known])
                least[~known] = np.maximum(edges(some_rough, count) - slack, -2)
            rows, place = np.nonzero(rough >= least[:, None].astype(np.float32))
            within = np.bitwise_count(q_codes[some[rows]] ^ found[place]) <= radius
            rows, place = rows[within], place[within]
        # The exact measure only for what can be among the best.
        scores = (c[place] * q[some[rows]]).sum(axis=1) / (lengths[place] * sizes[some[rows]])
        keep = ~(scores < bounds[some[rows]])
        rows, place, scores = rows[keep], place[keep], scores[keep]
        if len(rows):
            owner, named = ids.of(place)
            yield some[rows][owner], scores[owner], named


def nearest(rows: DataFrame, is_query, count: int, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest found by cosine for rows where ``is_query`` (of column ``id``)."""
    vectors = usable(rows, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    found = classes(vectors, count + 1)
    total = found.count()
    chosen = found.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < SAMPLE / max(total, 1) * 1_000_000)
    sample = [r.v for r in chosen.select("v").limit(2 * SAMPLE).collect()] or [[1.0]]
    width = max(map(len, sample))
    codes = fit(_unit(np.array([v + [0.0] * (width - len(v)) for v in sample])), count)
    queries, asked = asked_of(vectors.where(is_query), found)
    held = blocks(found, F.size("v"))

    def within(asked: DataFrame, radius: int) -> DataFrame:
        def prepare(items):
            return _indexed(items, codes, radius)

        def run(asked, block, bounds):
            return _nearest(asked, block, bounds, codes, radius, count + 1)

        near = top_found(asked, held, prepare, run, count + 1)
        place = F.row_number().over(Window.partitionBy("rep").orderBy(F.col("score").desc(), "id"))
        return near.withColumn("place", place).where(F.col("place") <= count + 1).drop("place")

    near = within(asked, codes.radius)
    if codes.radius < BITS:
        near = materialize(near, "near")
        enough = near.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") > count).select("rep")
        short = materialize(asked.join(enough, "rep", "left_anti"), "short")
        if not short.isEmpty():
            near = near.join(short.select("rep"), "rep", "left_anti").unionByName(within(short, BITS))
    return ranked(near, queries, count)
