"""Phrase collocations: phrase counts from suffix subtrees built prefix by prefix within a memory budget.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every
word position starts a suffix of at most ``DEPTH`` words of its piece.

* Vertical partitioning: prefixes of one word are counted first. A prefix with more
  than ``budget`` suffixes is replaced by its extensions of one more word, counted
  by another pass over the texts, until each prefix fits or has full depth.
* Prefixes are dealt into as many groups as keep a group within the budget. A task
  gets the suffixes of one group, sorts them into the leaves of its subtree, cut off
  at ``DEPTH`` words, and reads the count of each inner node from the leaves below.
* What workers must know of the prefixes (which are frequent, which are extended) is
  two bit maps of ``BITS`` bits each and level. A prefix that shares a bit with
  another is at worst extended or kept without need; counts stay exact.

Words stand as 64-bit hashes of language and word; words are counted as text, and a
hash that a frequent word shares is noticed and replaced by another.

A null text is empty, a null language is ``und``. Repeated rows count as often as
they occur; ties in the ranking end with the phrase itself, in byte order. Without
rows the result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import math
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.batches import text_slices
from ledgerlens.llm.shingles import mix
from ledgerlens.session import materialize

DEPTH = 4
#: Most suffixes of a prefix, and of a group of prefixes on average.
BUDGET = 1_000_000
#: Bits of a map of prefixes; a power of two and a multiple of the bits of one stored bitmap.
BITS = 1 << 24
_PART = 32_768
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Fixed: A-Z become small letters, what ends a piece becomes a line end, a tab a space.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(_ENDS) + b" "
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in order; ``\\n`` stands where a piece ends, and at the end."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).replace(b"\n", b" \n ")
    return [*filter(None, plain.split(b" ")), b"\n"]


def _hashes(words: list[bytes], langs: list[str], sizes: list[int], seed: int) -> np.ndarray:
    """One hash of language and word per word; 0 where a piece ends."""
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words))
    ends = found == np.uint64(xxhash.xxh3_64_intdigest(b"\n", seed))
    salts = np.array([xxhash.xxh3_64_intdigest(lang.encode(), seed) for lang in langs], np.uint64)
    found = mix(found ^ mix(np.repeat(salts, sizes)))
    found[ends] = 0
    return found


def _slices(batches, characters: int):
    """(words, languages, numbers of words) of some texts at a time."""
    for batch, texts in text_slices(batches, "text", rows=100_000, characters=characters):
        split = [words_of(t) for t in texts]
        yield list(chain.from_iterable(split)), batch.column("lang").to_pylist(), list(map(len, split))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _count_words(texts: DataFrame, seed: int) -> DataFrame:
    """``lang, word, h, n`` of every word."""

    def run(batches):
        for words, langs, sizes in _slices(batches, 2_000_000):
            hashes = _hashes(words, langs, sizes, seed)
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            keep = found != 0
            found, first, n = found[keep], first[keep], n[keep]
            owner = np.searchsorted(np.cumsum(sizes), first, side="right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[i] for i in owner], pa.string()),
                    pa.array([words[i] for i in first], pa.binary()).cast(pa.string()),
                    _longs(found),
                    pa.array(n, pa.int64()),
                ],
                ["lang", "word", "h", "n"],
            )

    counted = texts.mapInArrow(run, "lang string, word string, h long, n long")
    return counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


class PrefixMap:
    """A set of prefixes as bits; may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, prefixes: DataFrame) -> PrefixMap:
        """From column ``p``. Spark makes the parts; the driver gets at most ``BITS`` bits."""
        at = F.pmod(F.col("p"), F.lit(BITS)) + 1
        parts = prefixes.select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
        parts = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
        bits = np.zeros(BITS // 8, np.uint8)
        for part in parts.toLocalIterator():
            start = (part["part"] - 1) * _PART // 8
            bits[start : start + _PART // 8] = np.frombuffer(part["bits"], np.uint8)
        return cls(bits)

    def __contains__(self, prefix: int) -> bool:
        return bool(self.has(np.array([prefix], np.uint64))[0])

    def has(self, prefixes: np.ndarray) -> np.ndarray:
        at = prefixes & np.uint64(BITS - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _suffixes(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """(positions, DEPTH): suffixes that begin with a frequent word, cut before the first other one; zeros behind."""
    padded = np.concatenate((np.where(frequent, hashes, np.uint64(0)), np.zeros(DEPTH, np.uint64)))
    starts = np.flatnonzero(padded[: len(hashes)])
    found = np.stack([padded[starts + i] for i in range(DEPTH)], axis=1) if len(starts) else np.zeros((0, DEPTH), np.uint64)
    for i in range(1, DEPTH):
        found[found[:, i - 1] == 0, i] = 0
    return found


def _prefix(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _STEP + word)


def _distinct(rows: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct rows, how often each occurs, and what ``others`` hold at them."""
    if not len(rows):
        return rows, np.zeros(0, np.int64), list(others)
    key = rows[:, 0].copy()
    for i in range(1, rows.shape[1]):
        key = _prefix(key, rows[:, i])
    order = np.argsort(key)
    rows = rows[order]
    # Rows are compared whole: equal keys of different rows would only leave a row in two parts.
    first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1))))
    return rows[first], np.diff(np.append(first, len(rows))), [o[order][first] for o in others]


def _extended(texts: DataFrame, seed: int, maps: list[tuple[PrefixMap, PrefixMap]], least: int) -> DataFrame:
    """``p, w array<long>, n``: the extensions, by one word, of the prefixes that the last level marks as too large."""
    level = len(maps)
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        known = shared.value
        for words, langs, sizes in _slices(batches, 2_000_000):
            hashes = _hashes(words, langs, sizes, seed)
            rows = _suffixes(hashes, known[0][0].has(hashes) & (hashes != 0))
            prefix = rows[:, 0].copy()
            for i in range(level):
                keep = known[i][0].has(prefix) & known[i][1].has(prefix) & (rows[:, i + 1] != 0)
                rows, prefix = rows[keep], prefix[keep]
                prefix = _prefix(prefix, rows[:, i + 1])
            found, n, (prefix,) = _distinct(rows[:, : level + 1], prefix)
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * (level + 1))
            lists = pa.ListArray.from_arrays(offsets, _longs(found.ravel()))
            yield pa.RecordBatch.from_arrays([_longs(prefix), lists, pa.array(n, pa.int64())], ["p", "w", "n"])

    counted = texts.mapInArrow(run, "p long, w array<long>, n long")
    return counted.groupBy("p", "w").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _dealt(texts: DataFrame, seed: int, maps: list[tuple[PrefixMap, PrefixMap]], groups: int) -> DataFrame:
    """``grp, rows``: distinct suffixes of some texts, those of a group end to end in one value."""
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        known = shared.value
        for words, langs, sizes in _slices(batches, 4_000_000):
            hashes = _hashes(words, langs, sizes, seed)
            rows = _suffixes(hashes, known[0][0].has(hashes) & (hashes != 0))
            rows = rows[rows[:, 1] != 0]
            # The prefix of each suffix: of one word, or extended for as long as it is marked as too large.
            prefix, size = rows[:, 0].copy(), np.ones(len(rows), np.uint8)
            keep = np.ones(len(rows), bool)
            for i, (frequent, large) in enumerate(known, start=1):
                mine = np.flatnonzero(keep & (size == i))
                usual = frequent.has(prefix[mine])
                keep[mine[~usual]] = False
                mine = mine[usual]
                mine = mine[large.has(prefix[mine])]
                ended = rows[mine, i] == 0
                keep[mine[ended]] = False  # that prefix itself is counted already
                mine = mine[~ended]
                prefix[mine] = _prefix(prefix[mine], rows[mine, i])
                size[mine] = i + 1
            rows, prefix, size = rows[keep], prefix[keep], size[keep]
            rows, n, (prefix, size) = _distinct(rows, prefix, size)
            group = (prefix % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((rows[:, 1], rows[:, 0], group))
            rows, n, size, group = rows[order], n[order], size[order], group[order]
            cuts = np.flatnonzero(np.diff(group)) + 1 if len(group) else np.zeros(0, np.int64)
            edges = [0, *cuts.tolist(), len(group)] if len(group) else [0]
            packed, names = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                columns = [rows[a:b, i].tobytes() for i in range(DEPTH)]
                packed.append(b"".join([*columns, n[a:b].astype("<u4").tobytes(), size[a:b].tobytes()]))
                names.append(group[a])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["grp", "rows"])

    return texts.mapInArrow(run, "grp long, rows binary")


def subtree(rows: np.ndarray, n: np.ndarray, sizes: np.ndarray, least: int):
    """Yields (depth, words, counts) of the nodes below the prefixes that occur ``least`` times.

    ``rows`` are suffixes with their occurrences ``n`` and the length of their prefix.
    Sorted, they are the leaves in order; a node is a run of leaves that begin alike.
    """
    order = np.lexsort([rows[:, i] for i in reversed(range(DEPTH))])
    rows, n, sizes = rows[order], n[order], sizes[order]
    totals = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
    starts = np.ones(len(rows), bool)
    differs = np.zeros(len(rows), bool)
    differs[:1] = True
    for depth in range(1, DEPTH + 1):
        differs[1:] |= rows[1:, depth - 1] != rows[:-1, depth - 1]
        starts = np.flatnonzero(differs)
        counts = np.diff(totals[np.append(starts, len(rows))])
        below = (sizes[starts] < depth) | (depth == DEPTH)
        keep = below & (counts >= least) & (rows[starts, depth - 1] != 0)
        if depth > 1 and keep.any():
            yield depth, rows[starts[keep], :depth], counts[keep]


def _nodes(dealt: DataFrame, least: int) -> DataFrame:
    """``w array<long>, n`` of the frequent nodes of all subtrees, one group of prefixes at a time."""

    def build(group: pa.Table) -> pa.Table:
        parts = []
        for value in group.column("rows"):
            raw = value.as_buffer()
            size = len(raw) // (8 * DEPTH + 5)
            words = np.frombuffer(raw, "<u8", DEPTH * size).reshape(DEPTH, size).T
            n = np.frombuffer(raw, "<u4", size, 8 * DEPTH * size)
            parts.append((words, n, np.frombuffer(raw, np.uint8, size, (8 * DEPTH + 4) * size)))
        found = list(subtree(*(np.concatenate(p) for p in zip(*parts, strict=True)), least))
        lists = [row for _, words, _ in found for row in words.view(np.int64).tolist()]
        counts = [n for _, _, part in found for n in part.tolist()]
        return pa.table({"w": pa.array(lists, pa.list_(pa.int64())), "n": pa.array(counts, pa.int64())})

    return dealt.groupBy("grp").applyInArrow(build, "w array<long>, n long")


def _counted(texts: DataFrame, least: int, budget: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (``lang, word, p, n``), frequent phrases (``w, n``) and occurrences per language (``lang, total``)."""
    seed = 0
    while True:
        words = materialize(_count_words(texts, seed), "words")
        shared = words.groupBy("h").agg(F.count("*").alias("words"), F.max("n").alias("most"))
        if shared.where((F.col("words") > 1) & (F.col("most") >= least)).isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    own = words.where(F.col("n") >= least).select("lang", "word", F.col("h").alias("p"), "n")
    suffixes = own.agg(F.sum("n")).first()[0] or 0

    maps, level, known = [], own, own.select(F.array("p").alias("w"), "n")
    while True:
        large = level.where(F.col("n") > budget)
        maps.append((PrefixMap.of(level), PrefixMap.of(large)))
        if len(maps) == DEPTH - 1 or large.isEmpty():
            break
        level = materialize(_extended(texts, seed, maps, least), "prefixes")
        known = known.union(level.select("w", "n"))
    groups = max(1, math.ceil(2 * suffixes / budget))
    return own, known.union(_nodes(_dealt(texts, seed, maps, groups), least)), totals


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    first: int = 2_000,
    covered: tuple[int, int] = (80, 100),
    budget: int = BUDGET,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` best phrases of each language.

    A phrase of 2 to ``DEPTH`` words that occurs ``least`` times scores
    floor(2000000 * a / (l + r)) at its worst cut. It is left out if a longer one
    around it has at least the share ``covered`` of its occurrences.
    """
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"))
    own, known, totals = _counted(texts, least, budget)
    known = materialize(known, "phrases")

    parts = [
        F.when(F.size("w") >= max(at + size, size + 1), F.slice("w", at + 1, size))
        for size in range(2, DEPTH)
        for at in range(DEPTH - size + 1)
    ]
    around = known.select("n", F.explode(F.array(*parts)).alias("w")).where("w is not null")
    around = around.groupBy("w").agg(F.max("n").alias("most"))
    share, whole = covered
    phrases = known.where(F.size("w") > 1).join(around, "w", "left")
    open_ = F.col("most").isNull() | (F.col("most").cast("decimal(38,0)") * whole < F.col("n").cast("decimal(38,0)") * share)
    phrases = phrases.where(open_).select("w", F.col("n").alias("a"))

    # Each candidate asks for the counts of both parts of each cut.
    cuts = phrases.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    left = F.struct(F.lit(0).alias("side"), F.slice("w", F.lit(1), F.col("k")).alias("part"))
    right = F.struct(F.lit(1).alias("side"), F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("part"))
    asked = cuts.select("w", "a", "k", F.explode(F.array(left, right)).alias("s")).select("w", "a", "k", "s.side", "s.part")
    answers = asked.join(known.select(F.col("w").alias("part"), "n"), "part").groupBy("w", "a", "k")
    sides = answers.agg(*[F.max(F.when(F.col("side") == i, F.col("n"))).alias(name) for i, name in enumerate("lr")])
    score = F.expr("cast(2000000 as decimal(38,0)) * a div (cast(l as decimal(38,0)) + r)").cast("long")
    worst = sides.groupBy("w", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))

    spelled = worst.select("w", F.posexplode("w").alias("at", "p")).join(own.select("p", "lang", "word"), "p")
    spelled = spelled.groupBy("w").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("s"))
    spelled = spelled.select("w", "lang", F.array_join("s.word", " ").alias("phrase"))
    rows = worst.join(spelled, "w").select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    # The limit on the rank holds in each task before the shuffle: a frequent language does not gather.
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first).join(totals, "lang")
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
