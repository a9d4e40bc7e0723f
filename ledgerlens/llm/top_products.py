"""Exact top-k by integer inner product, with vectors grouped by length.

Vectors of about one length (within a tenth) form a bucket, dealt into blocks.
Passes over the longest vectors, then over more, give each query a score that its
k-th best cannot be below, and the blocks a task has seen raise it. In a block that score, over the lengths of query
and longest vector, is a threshold for the cosine. Above one nothing in the block
can reach it. A high threshold prunes by coordinates: a vector at that cosine
must have each of the query's largest coordinates in a narrow range. A low one
prunes by length: only vectors long enough are looked at. What remains is
verified by its exact product.

Nulls: rows whose id or vector is null, or whose vector is empty or has a null or
non-finite component, take no part. Shorter vectors count as ending in zeros.
Repeated rows are one; equal vectors under other ids each rank, ties to smaller
ids. Products are exact while they stay below 2**53.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.vector_blocks import SCORED, Ids, asked_of, blocks, classes, edges, matrix, ranked, same_width, top_found, usable

RATIO = 0.9
#: From this cosine on, coordinate ranges are narrow enough to be worth looking at.
NARROW = 0.6
FOCUS = 3


def _length(v):
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def _candidates(q: np.ndarray, cosine: float, unit: np.ndarray, lengths: np.ndarray, least: float) -> np.ndarray:
    """Places of the vectors (ordered by falling length) that may reach ``least``, a length or more of them."""
    size = int(np.searchsorted(-lengths, -least, side="right"))
    if cosine < NARROW:
        return np.arange(size)
    slack = 1e-9
    keep = np.ones(size, dtype=bool)
    across = math.sqrt(max(0.0, 1 - cosine * cosine))
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        middle, width = q[f] * cosine, across * math.sqrt(max(0.0, 1 - q[f] * q[f])) + slack
        # A vector may be nearer than the threshold: then the range up to the query's own coordinate is open.
        low = -1 - slack if q[f] < 0 and -q[f] >= cosine else middle - width
        high = 1 + slack if q[f] > 0 and q[f] >= cosine else middle + width
        keep &= (unit[:size, f] >= low) & (unit[:size, f] <= high)
    return np.flatnonzero(keep)


def _by_length(items):
    """A block's vectors by falling length, with lengths, directions and places in the block."""
    c = matrix(items.field("v"))
    lengths = np.sqrt((c * c).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    c, lengths = c[order], lengths[order]
    return c, lengths, c / np.where(lengths > 0, lengths, 1)[:, None], order, Ids(items)


def _products(asked, block, bounds: np.ndarray, count: int):
    """Yields the queries' best of one block of vectors, none below its known bound."""
    c, lengths, unit, order, ids = block
    q, c = same_width(matrix(asked.field("v")), c)
    unit = np.pad(unit, ((0, 0), (0, c.shape[1] - unit.shape[1])))
    sizes = np.sqrt((q * q).sum(axis=1))
    whole = []
    for i, bound in enumerate(bounds.tolist()):
        if not bound > 0 or sizes[i] == 0:
            whole.append(i)
            continue
        cosine = bound / (sizes[i] * lengths[0]) if lengths[0] else math.inf
        if cosine > 1 + 1e-9:
            continue
        least = bound / sizes[i] * (1 - 1e-9)
        if cosine < NARROW and lengths[-1] >= least:
            whole.append(i)
            continue
        place = _candidates(q[i] / sizes[i], min(cosine, 1.0), unit, lengths, least)
        scores = c[place] @ q[i]
        place, scores = place[scores >= bound], scores[scores >= bound]
        if len(place):
            owner, named = ids.of(order[place])
            yield np.full(len(owner), i), scores[owner], named
    # Queries that no vector of the block is too short for: verified together.
    for at in range(0, len(whole), SCORED):
        some = np.array(whole[at : at + SCORED])
        scores = q[some] @ c.T
        known = ~np.isnan(bounds[some])
        least = bounds[some]
        least[~known] = edges(scores[~known], count)
        rows, place = np.nonzero(scores >= least[:, None])
        if len(rows):
            owner, named = ids.of(order[place])
            yield some[rows][owner], scores[rows, place][owner], named


def top_products(rows: DataFrame, is_query, count: int, scale: int = 1024, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows where ``is_query`` (of column ``id``) the ``count`` highest products.

    Components are taken as floor(scale * x). The query's own row is no candidate.
    """
    vectors = usable(rows, id_col, vector_col)
    vectors = vectors.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    found = classes(vectors, count + 1)
    queries, asked = asked_of(vectors.where(is_query), found)
    length = _length(F.col("v"))
    bucket = F.when(length > 0, F.floor(F.log(length) / -math.log(RATIO))).otherwise(F.lit(-(2**31))).cast("int")

    def run(asked, block, bounds):
        return _products(asked, block, bounds, count + 1)

    scores = top_found(asked, blocks(found, bucket), _by_length, run, count + 1)
    return ranked(scores.withColumn("score", F.col("score").cast("long")), queries, count)
