"""Join shapes beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_every_match(facts: DataFrame, matches: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Every fact row paired with every row of ``matches`` (a constant-filtered dimension).

    Facts are spread over as many salts as the session has shuffle partitions, by
    ``spread_by``, and the matches are copied once per salt: no task holds all
    facts. Adaptive execution broadcasts the copies where they are small.
    """
    salts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    return salted.join(matches.select("*", each.alias("_salt")), "_salt").drop("_salt")


def join_either_key(
    left: DataFrame,
    right: DataFrame,
    shared: Sequence[tuple[str, str]],
    alternatives: Sequence[tuple[str, str]],
) -> DataFrame:
    """Inner join on shared keys and (a1 = b1 OR a2 = b2 OR ...), each pair of rows once.

    An OR condition can only run as a nested loop inside the shared key. Each
    alternative becomes an equi-join, and a pair already matched by an earlier
    alternative is skipped, so no distinct over the result is needed.
    """
    def equal(pair: tuple[str, str]) -> Column:
        return left[pair[0]] == right[pair[1]]

    base = reduce(lambda a, b: a & b, [equal(pair) for pair in shared])
    branches = []
    for i, pair in enumerate(alternatives):
        earlier = [~F.coalesce(equal(p), F.lit(False)) for p in alternatives[:i]]
        branches.append(left.join(right, reduce(lambda a, b: a & b, earlier, base & equal(pair))))
    return reduce(DataFrame.unionAll, branches)


def anti_join_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Left rows whose key tuple is absent from the right side (NULL keys are kept)."""
    keys = right.select(*[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(pairs)])
    condition = reduce(
        lambda a, b: a & b, [left[name] == keys[f"_k{i}"] for i, (name, _) in enumerate(pairs)]
    )
    return left.join(keys, condition, "left_anti")


def semi_join_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Left rows whose key tuple is present on the right side, each once."""
    keys = right.select(*[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(pairs)])
    condition = reduce(
        lambda a, b: a & b, [left[name] == keys[f"_k{i}"] for i, (name, _) in enumerate(pairs)]
    )
    return left.join(keys, condition, "left_semi")


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns renamed with a prefix, for joining one dimension in several roles."""
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])
