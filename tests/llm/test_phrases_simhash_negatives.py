"""Phrase mining, SimHash and hard negatives against brute force, with the odd cases their docstrings define."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import documents
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import hard_negatives, phrases, simhash


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# Phrases


def counted_phrases(rows):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, totals


def best_phrases(rows, least, first):
    counts, totals = counted_phrases(rows)
    frequent = {k: n for k, n in counts.items() if n >= least}
    covered = set()
    for (lang, w), n in frequent.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inner = lang, w[i : i + size]
                if 100 * n >= 80 * frequent[inner]:
                    covered.add(inner)
    found = defaultdict(list)
    for (lang, w), a in frequent.items():
        if len(w) < 2 or (lang, w) in covered:
            continue
        cuts = [(2_000_000 * a // (frequent[lang, w[:k]] + frequent[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), frequent[lang, w[:k]], frequent[lang, w[k:]]))
    out = []
    for lang, items in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(items)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def odd_texts():
    r = random.Random(3)
    hot = "zug um zug"
    rows = []
    for i in range(120):
        words = [r.choices("abcdefgh", weights=[30, 20, 9, 5, 3, 2, 1, 1])[0] for _ in range(r.randrange(0, 60))]
        text = ""
        for w in words:
            text += (w.upper() if r.random() < 0.3 else w) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " é\x1c "])
        rows.append((text + hot, r.choice(["en", "fr", None])))
    return [*rows, ("", "en"), (None, "fr"), (None, None), ("...", "de"), rows[0], rows[0], ("a b " * 4_000, "en")]


@pytest.mark.parametrize("budget", [20, 400, 1_000_000])
def test_phrases_equal_brute_force_for_any_budget(spark, budget):
    rows = odd_texts()
    docs = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, n int, word int").repartition(3)
    got = phrases.collocations(docs, least=5, first=40, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == best_phrases(rows, 5, 40)


def test_phrases_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).count() == 0
    docs = spark.createDataFrame([(None, None), ("", "en"), (" \t..", "en")], "text string, lang string")
    assert phrases.collocations(docs).count() == 0


def test_prefix_map_holds_what_was_put_in(spark):
    values = [0, 1, -1, 5, 2**62, -(2**62), 123456789, 32767, 32768, 2**24 - 1]
    held = phrases.PrefixMap.of(spark.createDataFrame([(v,) for v in values], "p long"))
    assert all((v % 2**64) in held for v in values)
    assert 77 not in held and int(np.unpackbits(held.bits).sum()) == len({v % phrases.BITS for v in values})


def test_subtree_counts_are_leaf_totals():
    rows = np.array([[1, 2, 3, 4], [1, 2, 0, 0], [1, 2, 3, 0], [1, 5, 3, 0]], np.uint64)
    found = {
        tuple(w): n
        for _, words, counts in phrases.subtree(rows, np.array([4, 1, 2, 7]), np.ones(4, np.uint8), 1)
        for w, n in zip(words.tolist(), counts.tolist(), strict=True)
    }
    assert found == {(1, 2): 7, (1, 5): 7, (1, 2, 3): 6, (1, 5, 3): 7, (1, 2, 3, 4): 4}


# SimHash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", lowered(text))
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Smallest id reachable from each id, of (id, fingerprint) pairs."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x), (j, y) in itertools.combinations(prints, 2):
        if i == j or (x ^ y).bit_count() <= 4:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: root(i) for i in parent}


def near_texts():
    r = random.Random(11)
    texts = []
    for group in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(300)]
        for _ in range(12 if group else 60):
            words = list(base)
            for _ in range(r.randrange(0, 4)):
                words[r.randrange(len(words))] = f"x{r.randrange(400)}"
            texts.append(" ".join(words))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n\t"), "", None, " \x0b ", "one", "one two three", "a b c d", "a b c d e", "ä " * 70_000]
    return texts


@pytest.mark.parametrize("block", [3, 2_048])
def test_simhash_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = near_texts()
    random.Random(5).shuffle(texts)
    prints = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    wanted = grouped(prints)
    got = simhash.simhash_duplicates(documents(spark, list(enumerate(texts)), print=1, node="x", component_id=3).repartition(5))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = {r.doc_id: (r.fingerprint, r.component_id) for r in got.collect()}
    assert rows == {i: (f"{p:016x}", wanted[i]) for i, p in prints}
    assert len(set(wanted.values())) < len(texts) - 60


def test_simhash_dense_fingerprints(spark, monkeypatch):
    """Fingerprints in tight clouds, where lists stay large and hold several components."""
    r = random.Random(2)
    centres = [r.getrandbits(64) for _ in range(4)]
    prints = []
    for i in range(400):
        p = r.choice(centres)
        for b in r.sample(range(64), r.randrange(2, 9)):
            p ^= 1 << b
        prints.append((i, p))
    monkeypatch.setattr(simhash, "BLOCK", 16)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    monkeypatch.setattr(simhash, "_fingerprints", lambda rows: rows.select("doc", F.col("text").cast("long").alias("print")))
    docs = spark.createDataFrame([(i, str(p)) for i, p in signed], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.simhash_duplicates(docs).collect()}
    assert got == grouped(prints)


def test_pigeonring_lists_and_chains_lose_no_pair():
    r = random.Random(1)
    for order in (0, 1):
        assert sorted(simhash.ORDERS[order]) == list(range(64))
        for _ in range(4_000):
            x, flips = r.getrandbits(64), r.sample(range(64), r.randrange(0, 5))
            y = x
            for b in flips:
                y ^= 1 << b
            passed = [
                chain
                for mask, chain in simhash.LISTS[order]
                if not (x ^ y) & mask % (1 << 64)
                and len(simhash._chained(np.uint64(x), np.array([y], np.uint64), chain))
            ]
            assert passed
    assert len({m for m, _ in simhash.LISTS[0]}) == math.comb(7, 3)


def test_simhash_repeated_ids_nulls_and_empty(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    docs = documents(spark, [(1, a), (1, a), (2, b), (3, a), (3, b), (None, a), (4, None), (5, "")])
    rows = Counter(tuple(r) for r in simhash.simhash_duplicates(docs).collect())
    x, y, zero = (f"{plain_fingerprint(t):016x}" for t in (a, b, ""))
    assert rows == Counter([(1, x, 1), (1, x, 1), (2, y, 1), (3, x, 1), (3, y, 1), (None, x, None), (4, zero, 4), (5, zero, 4)])
    assert simhash.simhash_duplicates(docs.limit(0)).count() == 0


# Hard negatives


def plain_negatives(rows, count=10):
    floor = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows]
    out = []
    for i, v, lab in floor:
        if i % 10:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, w, other in floor if j != i]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for score, j, _ in [s for s in scores if s[2] == lab][:5]:
            fits = [(s, k) for s, k, other in scores if other != lab and 30 * score <= 100 * s <= 90 * score]
            out += [(i, j, rank, k, score, s) for rank, (s, k) in enumerate(fits[:count], 1)]
    return sorted(out)


EMBEDDED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("block", T.IntegerType()),
    ]
)


def embedded(spark, rows):
    return spark.createDataFrame([(i, v, lab, "k", 1) for i, v, lab in rows], EMBEDDED).repartition(3)


@pytest.mark.parametrize("block", [8, 1_024])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    r = np.random.default_rng(4)
    rows = []
    for i in range(400):
        v = r.normal(size=6).astype(np.float32) * (0.1 if i % 3 else 1.5)
        if i % 4 == 0:
            v = np.array([0.5, 0.25, 0, 0, -0.5, 0.125], np.float32)  # one common vector
        if i % 41 == 0:
            v = np.zeros(6, np.float32)
        rows.append((i, v.tolist(), 1 if i % 3 == 0 else int(r.integers(0, 4))))
    odd = [(1000, None, 1), (1010, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1020, [float("nan")] * 6, 1), (1030, [1.0] * 6, None), (None, [1.0] * 6, 1), (1040, [], 1), (1050, [float("inf")] * 6, 2)]
    got = hard_negatives.hard_negatives(embedded(spark, rows + odd + rows[:7]), F.col("id") % 10 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_hard_negatives_without_rows_or_partners(spark):
    def run(rows):
        return hard_negatives.hard_negatives(embedded(spark, rows), F.col("id") % 10 == 0, F.col("label")).count()

    assert run([]) == 0
    assert run([(0, [1.0, 2.0], 1)]) == 0
    assert run([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2)]) == 0
    assert run([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2)]) == 1


def test_zone_bounds_hold_and_leave_blocks_out():
    r = np.random.default_rng(1)
    asked = r.normal(size=(30, 8))
    blocks = [r.normal(size=(20, 8)) * 0.1 + r.normal(size=8) for _ in range(15)]
    low, high = (np.stack([f(b, axis=0) for b in blocks]) for f in (np.min, np.max))
    longest = np.array([np.sqrt((b * b).sum(axis=1)).max() for b in blocks])
    least, most = hard_negatives.bounds(asked, low, high, longest)
    for z, b in enumerate(blocks):
        scores = asked @ b.T
        assert (scores >= least[:, z, None] - 1e-9).all() and (scores <= most[:, z, None] + 1e-9).all()
    # With these blocks a window around the best products needs a few of them only.
    top = (asked @ np.concatenate(blocks).T).max(axis=1)
    assert (most >= top[:, None]).mean() < 0.3


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hard_negatives.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()
