"""Near duplicates, repeated passages and sketches against brute force."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
from helpers import documents, prose
from pyspark.sql import functions as F

from ledgerlens.llm import near_dup, repeated_spans, shingles
from ledgerlens.llm.components import connected
from ledgerlens.session import materialize

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_sets(rows):
    out = {}
    for i, text in rows:
        words = WORDS.findall(lowered(text))
        out[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def components_by_hand(sets):
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            low[y] = x
    return {i: find(i) for i in sets}


def corpus():
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for base in range(12):
        words = prose(base, int(rng.integers(20, 200)))
        for _ in range(int(rng.integers(1, 14))):
            changed = list(words)
            for _ in range(int(rng.integers(0, 8))):
                changed[int(rng.integers(0, len(changed)))] = f"x{rng.integers(0, 10**9)}"
            rows.append((at * 7 + 3, " ".join(changed)))
            at += 1
    passage = " ".join(prose(99, 60))
    rows += [(1_000 + k, passage + " " + " ".join(prose(200 + k, int(rng.integers(5, 40))))) for k in range(40)]
    rows += [(2_000 + k, "the very same text of some eight words") for k in range(30)]
    rows += [(3_000, None), (3_001, ""), (3_002, " \t\n"), (3_003, "One two"), (3_004, "one TWO"), (3_005, "É É É É É"), (3_006, "é é é é é")]
    rows += [(3_010, " ".join(prose(400, 20_000))), (3_011, " ".join(prose(400, 20_000)[:19_000]))]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    docs = documents(spark, [*rows, rows[0], rows[40]], n="clash", print="clash", component="clash", kept=False).repartition(7)
    got = near_dup.near_duplicates(docs).collect()
    sets = shingle_sets(rows)
    want = components_by_hand(sets)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_buckets_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = np.random.default_rng(9)
    base, rows = prose(1, 120), []
    for k in range(60):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 16))):
            words[at] = f"y{rng.integers(0, 10**9)}"
        rows.append((k, " ".join(words)))
    got = near_dup.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == components_by_hand(shingle_sets(rows))


def test_near_duplicates_of_few_rows(spark):
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0
    got = near_dup.near_duplicates(documents(spark, [(None, "a b c d e f"), (None, None), (4, "a b c d e f")])).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got) == [("4", 4, True), ("None", None, True), ("None", None, True)]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        pool = rng.integers(0, 2**63, 900).astype(np.uint64)
        common = int(600 * share / (1 + share))
        a, b = np.unique(pool[:300]), np.unique(np.concatenate((pool[:common], pool[300 : 600 - common])))
        got = [(shingles.sketch(shingles.mix(a + np.uint64(k)), 240) == shingles.sketch(shingles.mix(b + np.uint64(k)), 240)).mean() for k in range(40)]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(np.mean(got) - true) < 0.02
    for size in (1, 2, 7):
        assert len(set(shingles.sketch(pool[:size], 240).tolist())) > 200


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    rows = connected(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(51)} | {100 + k: 100 for k in range(40)} | {200: 200, 201: 200}
    assert {r.node: r.component for r in rows} == want


def repeats_by_hand(rows, size=13):
    words = {i: WORDS.findall(t or "") for i, t in rows}
    low = {}
    for i, w in words.items():
        for k in range(len(w) - size + 1):
            low[tuple(w[k : k + size])] = min(i, low.get(tuple(w[k : k + size]), i))
    out = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - size + 1) if low[tuple(w[k : k + size])] < i for j in range(k, k + size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_repeated_passages_equal_brute_force(spark):
    rows = corpus()
    again = prose(7, 30)
    rows += [(5_000, " ".join(again * 3)), (5_001, "a b " + " ".join(again[:13])), (5_002, " ".join(again[:12])), (5_003, "z " * 40), (5_004, "z " * 30)]
    docs = documents(spark, rows, starts="clash", n_words=1).repartition(5)
    got = repeated_spans.remove_repeats(docs).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_words.encode()).hexdigest()) for r in got}
    assert len(got) == len(rows) and found == repeats_by_hand(rows)


def test_repeated_passages_of_odd_rows(spark):
    long = " ".join(prose(3, 40))
    rows = [(None, long), (1, long), (1, long), (2, None), (3, long), (4, "")]
    got = repeated_spans.remove_repeats(documents(spark, rows), keep=["source"]).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == [
        ("1", 40, 0), ("1", 40, 0), ("2", 0, 0), ("3", 40, 40), ("4", 0, 0), ("None", 40, 0),
    ]
    assert repeated_spans.remove_repeats(documents(spark, [])).count() == 0


def test_repeats_double_until_none_are_left(spark):
    shared = prose(11, 120)
    rows = [(1, " ".join(prose(12, 30) + shared)), (2, " ".join(shared + prose(13, 20))), (3, " ".join(prose(14, 20) + shared[:30]))]
    found, _ = repeated_spans.repeated_windows(documents(spark, rows))
    longest = {(r.doc, r.at): r.length for r in repeated_spans.longest_repeats(found).collect()}
    assert longest[2, 0] == 104 and longest[1, 30] == 104 and longest[3, 20] == 26
    assert max(longest.values()) == 104 and longest[2, 100] == 13


def test_runs_and_windows_are_shuffled_once(spark):
    rows = documents(spark, corpus()).selectExpr("doc_id AS doc", "text")
    outline = materialize(repeated_spans._outline(rows, repeated_spans.WINDOW, repeated_spans.ANCHOR))
    runs = repeated_spans._repeated_runs(outline)
    found, _ = repeated_spans.repeated_windows(documents(spark, corpus()))
    for used, key in ((runs, "run"), (found.where("low < doc").groupBy("doc").agg(F.collect_set("at")), "hash")):
        assert used.collect()
        plan = used._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        moved = [line for line in plan.splitlines() if f"hashpartitioning({key}#" in line]
        assert len([line for line in moved if "ReusedExchange" not in line]) == 1 and "ReusedExchange" in plan
