"""A stated query set against all vectors, block by block.

Equal vectors are one class that lists its smallest ids: no more of them can be
among anyone's nearest. Classes are dealt into blocks of about ``BLOCK_ROWS``
rows, queries into blocks of about ``QUERY_ROWS``; both are stored. A task reads
some files of either and holds one block of vectors, its blocks of queries and
their best so far; nothing is copied, shuffled or broadcast for the meeting, and
a query leaves a task with its few best only. Passes over growing parts of the
vectors come first and bound what later ones look for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.session import ensure_batches, materialize

BLOCK_ROWS, QUERY_ROWS = 4_096, 4_096
#: The first pass reads about a block, each further one so many times more, as long as that is less than half of all.
GROWTH = 16
#: Queries whose scores are held at a time.
SCORED = 512
#: Tasks hold their queries as rows: with files of that size, the bytes of a split are those of the rows.
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
#: A reader decodes a group of rows as a whole, so a group holds a few blocks; their size is looked at after every other one.
FEW = {"parquet.block.size": str(8 << 20)} | {f"parquet.{kind}.size.row.check.{end}": "2" for kind in ("block", "page") for end in ("min", "max")}


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v array<double>`` of rows whose vector has components, all of them finite."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~odd)
    return kept.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def classes(vectors: DataFrame, ids: int) -> DataFrame:
    """``rep, v, ids``: each distinct vector with its ``ids`` smallest ids; ``rep`` is the smallest."""
    # By hash first: sorting compares numbers, and vectors only where these are equal.
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    # Spark applies the limit before the shuffle too, so a frequent vector does not gather.
    few = vectors.distinct().withColumn("h", F.xxhash64("v")).withColumn("place", place).where(F.col("place") <= ids)
    few = few.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return materialize(few.select(F.col("ids")[0].alias("rep"), "v", "ids"), "classes")


def blocks(found: DataFrame, bucket: Column) -> DataFrame:
    """``bucket, part, size, items array<struct<rep, v, ids>>``: the classes of a bucket in blocks."""
    dealt = found.withColumn("bucket", bucket)
    sizes = dealt.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    # A row per bucket. Rows that a shuffle had put together by bucket would stay so: one bucket, one task.
    dealt = dealt.join(F.broadcast(sizes), "bucket").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    item = F.struct("rep", "v", "ids")
    grouped = dealt.groupBy("bucket", "part").agg(F.collect_list(item).alias("items"))
    return materialize(grouped.select("bucket", "part", F.size("items").alias("size"), "items"), "blocks", **FEW)


def query_blocks(queries: DataFrame, columns: list[str], rows: int | None = None, key: str = "rep") -> DataFrame:
    """``block, asked array<struct<...>>``: stored blocks of about ``rows`` queries, ``QUERY_ROWS`` if not said."""
    parts = max(1, -(-queries.count() // (rows or QUERY_ROWS)))
    item = F.struct(*columns).alias("q")
    dealt = queries.select(F.pmod(F.xxhash64(key), F.lit(parts)).alias("block"), item)
    return materialize(dealt.groupBy("block").agg(F.collect_list("q").alias("asked")), "asked", **PLAIN, **FEW)


def paired(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Each row of ``held`` with each of ``asked``: a task reads its files of both, and keeps those of ``asked`` at hand.

    Both sides are stored tables. The hint names the join, so sizes that Spark reckons do not matter.
    """
    ensure_batches(held.sparkSession)
    return held.hint("shuffle_replicate_nl").crossJoin(asked)


def parts_of(total: int, first: int) -> list[int]:
    """How many rows the passes before the last one read."""
    out = []
    while 2 * (first * GROWTH ** len(out)) < total:
        out.append(first * GROWTH ** len(out))
    return out


def _growing(held: DataFrame) -> Iterator[DataFrame]:
    """Stored parts of the blocks, those of the greatest buckets, each ``GROWTH`` times the one before."""
    counted = held.groupBy("bucket").agg(F.sum("size").alias("rows"), (F.max("part") + 1).alias("parts"))
    buckets = counted.orderBy(F.col("bucket").desc()).collect()  # a row per bucket
    for wanted in parts_of(sum(b["rows"] for b in buckets), BLOCK_ROWS):
        before = 0
        for b in buckets:
            if before + b["rows"] >= wanted:
                break
            before += b["rows"]
        parts = -(-(wanted - before) * b["parts"] // b["rows"])
        last = (F.col("bucket") == b["bucket"]) & (F.col("part") < parts)
        yield materialize(held.where((F.col("bucket") > b["bucket"]) | last), "part", **FEW)


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows end in zeros."""
    sizes = lists.value_lengths().to_numpy()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))


Found = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


class Tops:
    """The ``count`` best scores and ids found so far for each of ``rows`` searches, ties to smaller ids."""

    def __init__(self, rows: int, count: int):
        self.scores, self.ids = np.full((rows, count), -np.inf), np.zeros((rows, count), np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Takes finds of the searches ``rows``; those of them that have their ``count`` now."""
        who, count = np.unique(rows), self.scores.shape[1]
        held = self.scores[who] > -np.inf
        rows = np.concatenate([rows, np.repeat(who, held.sum(axis=1))])
        scores, ids = np.concatenate([scores, self.scores[who][held]]), np.concatenate([ids, self.ids[who][held]])
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < count
        self.scores[rows[keep], place[keep]], self.ids[rows[keep], place[keep]] = scores[keep], ids[keep]
        return who[self.scores[who, -1] > -np.inf]


def edges(scores: np.ndarray, count: int) -> np.ndarray:
    """The ``count``-th highest score of each row."""
    if scores.shape[1] <= count:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - count, axis=1)[:, scores.shape[1] - count]


class Ids:
    """The ids that the classes of a block list."""

    def __init__(self, items: pa.StructArray):
        lists = items.field("ids")
        self.sizes, self.flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the classes at ``place``: which of them has an id, and that id."""
        sizes = self.sizes[place]
        owner = np.repeat(np.arange(len(place)), sizes)
        return owner, self.flat[self.starts[place][owner] + np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]]


def search(asked: DataFrame, held: DataFrame, prepare: Callable, run: Callable[..., Found], count: int) -> DataFrame:
    """``rep, score, id``: the ``count`` best of each query among the blocks of one task, none below its ``bound``.

    ``asked`` has blocks of ``rep, v, bound``. ``run(asked, prepared, bounds)`` yields places of queries in
    ``asked`` with scores and ids found in a block of vectors, which ``prepare`` has seen.
    """

    def each(batches):
        tops, name, prepared = {}, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                who = part.column("asked").flatten()
                here = tuple(part.column(c)[0].as_py() for c in ("bucket", "part"))
                if here != name:
                    name, prepared = here, prepare(part.column("items").flatten())
                block = part.column("block")[0].as_py()
                if block not in tops:
                    bounds = who.field("bound").to_numpy(zero_copy_only=False).astype(np.float64)  # NaN: not known
                    tops[block] = who.field("rep").to_numpy().copy(), bounds.copy(), Tops(len(who), count)
                _, bounds, top = tops[block]
                for rows, scores, ids in run(who, prepared, bounds):
                    full = top.add(rows, scores, ids)
                    bounds[full] = top.scores[full, -1]
        for reps, _, top in tops.values():
            rows, place = np.nonzero(top.scores > -np.inf)
            columns = [reps[rows], top.scores[rows, place], top.ids[rows, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "score", "id"])

    return paired(asked, held).select("bucket", "part", "items", "block", "asked").mapInArrow(each, "rep long, score double, id long")


def top_found(asked: DataFrame, held: DataFrame, prepare: Callable, run: Callable[..., Found], count: int) -> DataFrame:
    """``rep, score, id`` with the ``count`` best of each of ``asked`` (``rep, v``) and some that are not."""
    place = F.row_number().over(Window.partitionBy("rep").orderBy(F.col("score").desc(), "id"))
    known = asked.withColumn("bound", F.lit(None).cast("double"))
    for part in _growing(held):
        seen = search(query_blocks(known, ["rep", "v", "bound"]), part, prepare, run, count)
        full = seen.withColumn("place", place).where(F.col("place") <= count).where(F.col("place") == count)
        known = asked.join(materialize(full.select("rep", F.col("score").alias("bound")), "bounds"), "rep", "left")
    return search(query_blocks(known, ["rep", "v", "bound"]), held, prepare, run, count)


def asked_of(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the queries ``id, v``: ``id, rep`` of each, and ``rep, v`` of the classes that they ask for."""
    known = found.select(F.xxhash64("v").alias("h"), "v", "rep")
    queries = rows.distinct().withColumn("h", F.xxhash64("v")).join(known, ["h", "v"])
    queries = materialize(queries.select("id", "rep", "v"), "queries")
    return queries.select("id", "rep"), queries.groupBy("rep").agg(F.first("v").alias("v"))


def ranked(found: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``count`` best, without itself.

    ``found`` has at least ``count + 1`` candidates per distinct query vector if
    there are as many; ``queries`` (``id, rep``) names the queries of each.
    """
    order = [F.col("score").desc(), F.col("id")]
    top = found.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy(*order)))
    lists = top.where(F.col("place") <= count + 1).groupBy("rep").agg(F.collect_list(F.struct("place", "score", "id")).alias("top"))
    own = queries.join(lists, "rep").select(
        F.col("id").alias("query_id"), F.filter(F.sort_array("top"), lambda t: t["id"] != F.col("id")).alias("top")
    )
    rows = own.select("query_id", F.posexplode(F.slice("top", 1, count)).alias("at", "t"))
    return rows.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.id").alias("vec_id"), F.col("t.score").alias("score"))
