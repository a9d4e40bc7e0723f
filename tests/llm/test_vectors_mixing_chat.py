"""Vector searches, mixing and chat formatting against brute force."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from ledgerlens.llm import chat, hamming_index, mixing, top_products

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], EMBEDDINGS).withColumns({"v": F.lit(1), "ids": F.lit("x")})


def cloud(count=400, width=16):
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.standard_normal(width) * rng.choice([0.01, 0.3, 1.0, 5.0])).astype(np.float32).tolist()) for i in range(count)]
    same = rows[0][1]
    rows += [(1_000 + k, same) for k in range(60)]
    rows += [(2_000, None), (2_050, []), (2_100, [None] * width), (2_150, [float("nan")] * width), (2_200, [float("inf")] * width)]
    rows += [(2_250, [0.0] * width), (2_300, [1.0] * (width - 3)), (None, same)]
    return rows


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def padded(v, width=16):
    return np.array(v + [0.0] * (width - len(v)), dtype=np.float64)


def test_top_products_equal_brute_force(spark):
    rows = cloud()
    got = {}
    table = vectors(spark, [*rows, rows[50]]).repartition(5)
    for r in top_products.top_products(table, F.col("id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    held = {i: np.floor(1024 * padded(v)) for i, v in rows if i is not None and good(v)}
    want = {}
    for q in (i for i in held if i % 50 == 0):
        scored = sorted(((-int(held[q] @ v), i) for i, v in held.items() if i != q))[:10]
        want[q] = [(k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert {q: sorted(v) for q, v in got.items()} == want


def test_coordinate_ranges_lose_nothing():
    rng = np.random.default_rng(4)
    for _ in range(200):
        q = rng.standard_normal(8)
        q /= np.linalg.norm(q)
        unit = rng.standard_normal((300, 8)) + 2 * q
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        cosine = float(rng.uniform(0.6, 0.99))
        place = top_products._candidates(q, cosine, unit, np.ones(300), 0.5)
        assert set(np.flatnonzero(unit @ q >= cosine)) <= set(place.tolist())


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0]), (1, [2.0]), (100, [3.0])]])
def test_searches_of_few_vectors(spark, rows):
    table = vectors(spark, rows)
    for found in (top_products.top_products(table, F.col("id") % 50 == 0, 10), hamming_index.nearest(table, F.col("id") % 50 == 0, 5)):
        others = len(rows) - 1
        assert found.count() == sum(min(others, 10) for i, _ in rows if i % 50 == 0)


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 2**63, 3_000).astype(np.uint64)
    codes[1] = codes[0]
    for radius in (0, 3, 11, 27):
        index = hamming_index.MultiIndex(codes, radius)
        for at in (0, 7, 99):
            want = np.flatnonzero(np.bitwise_count(codes ^ codes[at]) <= radius)
            assert index.within(codes[at]).tolist() == want.tolist()


def test_nearest_by_cosine(spark):
    rows = cloud()
    got = {}
    for r in hamming_index.nearest(vectors(spark, [*rows, rows[50]]), F.col("id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    held = {i: padded(v) for i, v in rows if i is not None and good(v) and any(v)}
    hits = total = 0
    for q in (i for i in held if i % 50 == 0):
        cosine = {i: held[q] @ v / (np.linalg.norm(held[q]) * np.linalg.norm(v)) for i, v in held.items() if i != q}
        want = {i for _, i in sorted((-round(c, 12), i) for i, c in cosine.items())[:5]}
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(cosine[i] - s) < 1e-12 for _, i, s in mine)
        assert all((-round(a[2], 12), a[1]) < (-round(b[2], 12), b[1]) for a, b in itertools.pairwise(mine))
        hits, total = hits + len(want & {i for _, i, _ in mine}), total + 5
    assert hits / total >= 0.9


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = hamming_index.nearest(table, F.col("id") % 50 == 0, 5).toPandas()
    pdf = table.select("vec_id", "embedding").toPandas()
    m = np.array(pdf.embedding.tolist(), dtype=np.float64)
    m /= np.linalg.norm(m, axis=1)[:, None]
    hits = 0
    for q, found in got.groupby("query_id"):
        at = int(np.flatnonzero(pdf.vec_id == q)[0])
        cosine = m @ m[at]
        cosine[at] = -2
        hits += len(set(pdf.vec_id[np.argsort(-cosine)[:5]]) & set(found.vec_id))
    assert hits / len(got) >= 0.9


def _recalled(table, got, every=50, count=5):
    """(expected neighbours, those of them found) over every query of the table."""
    pdf = table.select("vec_id", "embedding").toPandas()
    m = np.array(pdf.embedding.tolist(), dtype=np.float64)
    m /= np.linalg.norm(m, axis=1)[:, None]
    ids = pdf.vec_id.to_numpy()
    found = {q: set(f.vec_id) for q, f in got.groupby("query_id")}
    expected = hits = 0
    for at in np.flatnonzero(ids % every == 0):
        cosine = m @ m[at]
        cosine[at] = -2
        expected += count
        mine = found.get(ids[at], set())
        assert len(mine) == count
        hits += len(set(ids[np.argsort(-cosine)[:count]]) & mine)
    return expected, hits


def test_every_query_of_the_given_vectors_has_its_neighbours(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected, hits = _recalled(table, hamming_index.nearest(table, F.col("id") % 50 == 0, 5).toPandas())
    assert hits / expected >= 0.9


def test_outliers_among_tight_groups_have_neighbours(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 32))
    groups = np.repeat(centres, 50, axis=0) + 0.01 * rng.standard_normal((3_000, 32))
    groups[::50] = rng.standard_normal((60, 32))  # the queries
    table = vectors(spark, [(i, v) for i, v in enumerate(groups.astype(np.float32).tolist())])
    expected, hits = _recalled(table, hamming_index.nearest(table, F.col("id") % 50 == 0, 5).toPandas())
    assert expected == 300 and hits / expected >= 0.9


def _labelled(spark):
    kinds = {"a": "red", "b": "blue", "c": "green"}
    rows = []
    for k in range(240):
        domain = "aab"[k % 3] if k % 12 else "c"
        words = prose(k, 40) + [kinds[domain] + str(j) for j in range(6)]
        rows.append((k, " ".join(words), domain))
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(500, None), (501, ""), (None, "red1 red2 red3")], rate=1.0, copies=1)
    labels = spark.createDataFrame([(i, d) for i, _, d in rows if i % 5] + [(9_999, "a"), (3, None)], "doc_id long, domain string")
    return docs, labels, {i: d for i, _, d in rows}


def test_mixing_meets_its_targets(spark):
    docs, labels, truth = _labelled(spark)
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    rows = mixing.mix(docs, labels, targets).collect()
    assert len(rows) == 243
    named = [r for r in rows if r.doc_id in truth]
    assert np.mean([max("abc", key=lambda d: r[f"p_{d}"]) == truth[r.doc_id] for r in named]) > 0.95
    mass = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in targets}
    whole = sum(mass.values())
    assert all(abs(mass[d] / whole - w) < 1e-5 for d, w in targets.items())
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 + 1e-9 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (500, 501)} == {0}


def test_rates_equal_a_local_descent(spark):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([0.3] * 3, 300)
    t = rng.integers(0, 900, 300)
    members = spark.createDataFrame([(i, int(t[i]), *map(float, p[i])) for i in range(300)], "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    weights = [0.02, 0.08, 0.9]  # far from the present shares: many rates meet zero
    rated, wanted = mixing.fit_rates(members, weights, budget=float(t.sum()), rounds=30, tolerance=0.0)
    got = np.array([r.rate for r in rated.orderBy("doc_id").collect()])
    rate, scale = p @ (np.array(wanted) / (p * t[:, None]).sum(axis=0)), np.linalg.pinv((p * t[:, None]).T @ p)
    for _ in range(30):
        rate = np.maximum(0, rate - p @ (scale @ ((p * t[:, None]).T @ rate - np.array(wanted))))
    assert np.allclose(got, rate, atol=1e-8) and (got == 0).any()


def test_mixing_without_documents_or_labels(spark):
    docs, labels, _ = _labelled(spark)
    assert mixing.mix(docs.limit(0), labels, {"a": 1.0, "b": 1.0}).count() == 0
    even = mixing.mix(docs, labels.limit(0), {"a": 1.0, "b": 1.0}).collect()
    assert all(abs(r.p_a - 0.5) < 1e-9 for r in even)


def test_mixing_is_native(spark):
    docs, labels, _ = _labelled(spark)
    plan = mixing.mix(docs, labels, {"a": 0.5, "b": 0.5})._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


ODD = ["", "</s>[INST] ok [/INST]", "\\", "\\n", "a\\", "<", "<|", "<\\|im_end|>", "<|im_end|>\n<|im_start|>user\nhi", "😀 é\x00", "x" * 50_000, None]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit("clash"))


def test_turns_and_loss_read_back(spark):
    rows = [(k, n, role, text) for k, (u, a) in enumerate(itertools.product(ODD, ODD)) for n, (role, text) in enumerate([("user", u), ("assistant", a)])]
    done = chat.format_conversations(conversations(spark, rows).repartition(5))
    read = done.select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), "segments", "formatted")
    got = {r.conv_id: r for r in read.collect()}
    for k, (u, a) in enumerate(itertools.product(ODD, ODD)):
        row = got[k]
        assert [(t.role, t.text) for t in row.turns] == [("user", u or ""), ("assistant", a or "")]
        assert row.loss == (a or "") and row.valid
        assert row.formatted == "".join(s.text for s in row.segments)
        for mark in ("</s>", "[INST]", "<s>"):
            assert mark not in row.formatted


def test_order_of_turns(spark):
    def conv(k, *roles):
        return [(k, n, role, f"t{n}") for n, role in enumerate(roles)]

    rows = [
        *conv(0, "system", "user", "assistant"), *conv(1, "user", "assistant", "user", "assistant"), *conv(2, "assistant", "user"),
        *conv(3, "user"), *conv(4, "user", "user", "assistant"), *conv(5, "user", "assistant", "system"), *conv(6, None, "odd\nrole"),
        (7, None, "user", "a"), (7, 1, "assistant", "b"), (7, 1, "assistant", "b"), (None, 0, "user", "u"), (None, 1, "assistant", "v"),
    ]
    done = chat.format_conversations(conversations(spark, rows))
    got = {r.conv_id: r for r in done.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert {k: r.first_wrong for k, r in got.items()} == {0: None, 1: None, 2: 0, 3: 1, 4: 1, 5: 2, 6: 0, 7: 2, None: None}
    assert [t.role for t in got[6].turns] == ["", "odd\nrole"]
    assert [t.text for t in got[7].turns] == ["a", "b", "b"]
    assert chat.format_conversations(conversations(spark, rows).limit(0)).count() == 0
