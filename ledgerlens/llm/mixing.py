"""Rates per document that bring a corpus to target weights of its domains.

A classifier fitted on a labelled table gives each document a probability for
every domain (soft membership). A document's rate says how often it should be
read; the expected tokens of a domain are the sum of rate * tokens * probability.
Projected gradient steps over the whole corpus fit nonnegative rates whose
domain totals match the targets in least squares. They start from the mean, over
a document's domains, of wanted to present tokens, so that a document of one
domain starts at that domain's own factor.

All work on rows is DataFrame expressions; the driver sees only sums per domain
and solves systems of that size.

A doc_id is one document: words of its repeated rows are counted together, rows
without a doc_id are one document with a null id. Nulls: a null text has no
words, so it keeps the prior probabilities and weighs nothing. Labels that are
null, or of documents that do not exist, teach nothing; without any label all
domains are equally probable.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize

#: Words are hashed to this many buckets; the fitted table has one row for each.
BUCKETS = 65_536
SPACES = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.explode_outer(F.split(F.lower(text), SPACES))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit_domains(
    docs: DataFrame, labels: DataFrame, domains: list[str], max_labels: int = 20_000, smoothing: float = 1.0
) -> tuple[DataFrame, list[float]]:
    """(``bucket, w0, w1, ...``: log probability of a bucket in each domain, log priors).

    ``labels`` has ``doc_id, domain``. About ``max_labels`` labelled documents are
    used at most, chosen by the hash of their id and read whole.
    """
    usable = labels.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).select("doc_id", "domain")
    share = max_labels / max(usable.count(), 1)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    # Bounded by max_labels, so the documents need no shuffle.
    taught = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    seen = taught.select("domain", _words(F.col("text")).alias("word")).where("word <> ''")
    counts = seen.groupBy(_bucket(F.col("word")).alias("bucket")).agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]
    )
    counts = materialize(counts, "word-counts")
    totals = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"t{k}") for k in range(len(domains))]).first()
    weights = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    logs = [
        F.log((F.coalesce(f"c{k}", F.lit(0)) + smoothing) / F.lit(float(totals[k]) + smoothing * BUCKETS)).alias(f"w{k}")
        for k in range(len(domains))
    ]
    sizes = {r.domain: r.n for r in chosen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    known = sum(sizes.values()) + len(domains)
    return weights.select("bucket", *logs), [math.log((sizes.get(d, 0) + 1) / known) for d in domains]


def memberships(docs: DataFrame, weights: DataFrame, priors: list[float], temper: float = 0.25) -> DataFrame:
    """``doc_id, n_tokens, p0, p1, ...``: words of each document and its probability of each domain.

    ``temper`` scales the summed log ratios: words are not independent, and
    untempered sums are all but certain.
    """
    count = len(priors)
    words = docs.select("doc_id", _words(F.col("text")).alias("word"))
    words = words.withColumn("bucket", F.when(F.col("word") != "", _bucket(F.col("word"))))
    scored = words.join(F.broadcast(weights), "bucket", "left").groupBy("doc_id").agg(
        F.count("bucket").alias("n_tokens"),
        *[F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in range(count)],
    )
    raw = [F.col(f"s{k}") * temper + priors[k] for k in range(count)]
    peak = F.greatest(*raw) if count > 1 else raw[0]
    scored = scored.select("doc_id", "n_tokens", *[F.exp(x - peak).alias(f"e{k}") for k, x in enumerate(raw)])
    whole = sum((F.col(f"e{k}") for k in range(1, count)), F.col("e0"))
    return scored.select("doc_id", "n_tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in range(count)])


def _mass(rate: Column, count: int) -> list[Column]:
    return [F.coalesce(F.sum(F.col("n_tokens") * F.col(f"p{k}") * rate), F.lit(0.0)).alias(f"m{k}") for k in range(count)]


def fit_rates(
    members: DataFrame, weights: list[float], budget: float | None = None, floors: list[int] = (), headroom: float = 1.25,
    rounds: int = 60, tolerance: float = 1e-6, stored_every: int = 8,
) -> tuple[DataFrame, list[float]]:
    """(``members`` with ``rate``, wanted totals per domain).

    ``weights`` are the target shares. ``budget`` is the wanted total of tokens;
    without one it is the least that lets every domain in ``floors`` (all, if
    empty) keep ``headroom`` times its present tokens. A document that more likely
    than not belongs to a domain in ``floors`` is read at least once: its rate is
    projected to one or more, other rates to zero or more.

    A step moves every rate against the gradient in the metric of tokens, scaled
    by the inverse of the domains' second moments, and cuts it at its bound. That is
    exact in one step while no rate meets its bound.
    """
    count = len(weights)
    members = materialize(members, "members")
    moments = [
        F.coalesce(F.sum(F.col("n_tokens") * F.col(f"p{i}") * F.col(f"p{j}")), F.lit(0.0)).alias(f"g{i}_{j}")
        for i in range(count)
        for j in range(count)
    ]
    row = members.agg(*_mass(F.lit(1.0), count), *moments).first()
    now = np.array(row[:count], dtype=float)
    scale = np.linalg.pinv(np.array(row[count:], dtype=float).reshape(count, count), rcond=1e-9)
    shares = np.array(weights, dtype=float) / sum(weights)
    if budget is None:
        held = [k for k in (floors or range(count)) if shares[k] > 0]
        budget = max((headroom * now[k] / shares[k] for k in held), default=0.0)
    wanted = shares * budget
    clean = sum((F.col(f"p{k}") for k in floors), F.lit(0.0))
    bound = F.when(clean >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    factors = [float(w / n) if n > 0 else 0.0 for w, n in zip(wanted, now, strict=True)]
    rated, rate = members, sum((F.col(f"p{k}") * factors[k] for k in range(1, count)), F.col("p0") * factors[0])
    rate = F.greatest(bound, rate)
    now = np.array(rated.agg(*_mass(rate, count)).first(), dtype=float)
    last = math.inf
    for step in range(1, rounds + 1):
        error = float(np.abs(now - wanted).max())
        # Done, or as near as bounds on the rates allow.
        if error <= tolerance * max(budget, 1.0) or abs(last - error) <= 1e-3 * tolerance * budget:
            break
        last = error
        move = scale @ (now - wanted)
        rate = F.greatest(bound, rate - sum((F.col(f"p{k}") * float(move[k]) for k in range(1, count)), F.col("p0") * float(move[0])))
        if step % stored_every == 0:
            rated = materialize(rated.withColumn("next", rate).drop("rate").withColumnRenamed("next", "rate"), "rates")
            rate = F.col("rate")
        now = np.array(rated.agg(*_mass(rate, count)).first(), dtype=float)
    return rated.withColumn("rate", rate), wanted.tolist()


def copies(rate: Column, doc_id: Column) -> Column:
    """Whole copies of a document: its rate, rounded up or down by the hash of its id so that expectations hold."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + draw).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], floors: list[str] = (), **fit) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>..., rate, copies`` for every document."""
    domains = list(targets)
    weights, priors = fit_domains(docs, labels, domains)
    members = memberships(docs, weights, priors)
    rated, _ = fit_rates(members, list(targets.values()), floors=[domains.index(d) for d in floors], **fit)
    named = [F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)]
    return rated.select("doc_id", "n_tokens", *named, "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))
