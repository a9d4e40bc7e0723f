"""Declared tests of many models, planned into few passes.

A ``Suite`` names what must hold for one model. ``violations`` counts everything that is
declared: row rules, row counts and key sets of a model come from one scan and one shuffle,
which all its key sets share; the foreign keys of all models together take one scan a model
and one shuffle. Both combine before they shuffle, so a key that holds a third of all rows
reaches its task as one row per map task.

NULLs: a NULL passes ranges, value lists, lengths and foreign keys, and breaks ``not_null``
and ``holds``. Key tuples with a NULL are no keys. Models without rows break ``one_row``,
``day_present`` and ``distinct_above`` only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.quality import checks


@dataclass(frozen=True)
class Rule:
    """Rows for which the SQL condition ``broken`` is true are violations."""

    test: str
    broken: str


@dataclass(frozen=True)
class Keys:
    """Key tuples that occur more than once are violations; with ``above``, no more distinct ones than that are one."""

    test: str
    columns: tuple[str, ...]
    above: int | None = None
    where: str | None = None


@dataclass(frozen=True)
class Count:
    """The number of rows that meet the SQL condition ``counted`` must be ``exactly`` this, or else at least one."""

    test: str
    counted: str
    exactly: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    """Every key has a row in ``parent``; ``pairs`` maps own columns to the parent's.

    With ``array`` the elements of that own array column stand for the column of this name.
    """

    test: str
    parent: str
    pairs: tuple[tuple[str, str], ...]
    array: str | None = None


Test = Rule | Keys | Count | ForeignKey


@dataclass(frozen=True)
class Suite:
    tests: Sequence[Test]
    contract: Mapping[str, str] = field(default_factory=dict)


def not_null(*columns: str) -> list[Test]:
    return [Rule(f"not_null_{c}", f"`{c}` IS NULL") for c in columns]


def unique(*columns: str, where: str | None = None) -> Test:
    return Keys("unique_" + "_".join(columns), columns, where=where)


def distinct_above(column: str, minimum: int) -> Test:
    return Keys(f"distinct_{column}", (column,), above=minimum)


def in_range(column: str, low: float | None = None, high: float | None = None) -> Test:
    bounds = [f"`{column}` < {low}"] * (low is not None) + [f"`{column}` > {high}"] * (high is not None)
    return Rule(f"range_{column}", " OR ".join(bounds) or "false")


def one_of(column: str, *values: str | int | bool) -> Test:
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v) for v in values)
    return Rule(f"values_{column}", f"`{column}` NOT IN ({listed})")


def length_within(column: str, low: int, high: int) -> Test:
    return Rule(f"length_{column}", f"`{column}` IS NOT NULL AND size(`{column}`) NOT BETWEEN {low} AND {high}")


def holds(name: str, condition: str, where: str = "true") -> Test:
    return Rule(f"holds_{name}", f"({where}) AND NOT coalesce({condition}, false)")


def one_row() -> Test:
    return Count("one_row", "true", exactly=1)


def day_present(column: str, as_of: date, days_ago: int) -> Test:
    return Count(f"day_{column}_{days_ago}", f"to_date(`{column}`) = DATE '{as_of - timedelta(days=days_ago)}'")


def foreign_key(parent: str, pairs: Mapping[str, str], array: str | None = None) -> Test:
    return ForeignKey(f"foreign_{'_'.join(pairs)}_{parent}", parent, tuple(pairs.items()), array)


def violations(models: Mapping[str, DataFrame], suites: Mapping[str, Suite]) -> DataFrame:
    """(model, test, violations) of everything declared, tests without a violation included."""
    spark = next(iter(models.values())).sparkSession
    declared = spark.createDataFrame(
        [row for model, suite in suites.items() for row in _declared(model, models[model], suite)],
        "model string, test string, kind string, bound bigint",
    )
    found = [_counts(model, models[model], suite) for model, suite in suites.items()]
    if any(isinstance(test, ForeignKey) for suite in suites.values() for test in suite.tests):
        orphans = orphan_keys(models, suites).groupBy("model", "test").agg(F.sum("n_rows").alias("n"))
        nothing = F.lit(0).cast("bigint")
        found.append(orphans.select("model", "test", "n", nothing.alias("keys"), nothing.alias("repeated")))
    counted = reduce(DataFrame.unionAll, [rows for rows in found if rows is not None])
    n, kind, bound = F.coalesce("n", F.lit(0)), F.col("kind"), F.col("bound")
    broken = (
        F.when(kind == "contract", bound)
        .when(kind == "unique", F.coalesce("repeated", F.lit(0)))
        .when(kind == "distinct", (F.coalesce("keys", F.lit(0)) <= bound).cast("bigint"))
        .when(kind == "exactly", (n != bound).cast("bigint"))
        .when(kind == "some", (n == 0).cast("bigint"))
        .otherwise(n)
    )
    # One row per declared test on either side: the number of tests written in code bounds both.
    return declared.join(F.broadcast(counted), ["model", "test"], "left").select("model", "test", broken.alias("violations"))


def _declared(model: str, df: DataFrame, suite: Suite) -> list[tuple[str, str, str, int | None]]:
    rows: list[tuple[str, str, str, int | None]] = []
    for test in suite.tests:
        match test:
            case Keys(above=None):
                rows.append((model, test.test, "unique", None))
            case Keys():
                rows.append((model, test.test, "distinct", test.above))
            case Count(exactly=None):
                rows.append((model, test.test, "some", None))
            case Count():
                rows.append((model, test.test, "exactly", test.exactly))
            case _:
                rows.append((model, test.test, "rows", None))
    if suite.contract:
        rows.append((model, "contract", "contract", len(checks.contract_differences(df.schema, suite.contract))))
    names = [row[1] for row in rows]
    if len(set(names)) < len(names):
        raise ValueError(f"{model}: tests of one name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return rows


def _counts(model: str, df: DataFrame, suite: Suite) -> DataFrame | None:
    """(model, test, n, keys, repeated) of the tests that some row meets, foreign keys aside.

    Each row is turned into the tests it counts for: broken rules, counted rows and its
    keys. A key is a struct over all key columns of the model, NULL where a set has no part.
    """
    tests = [test for test in suite.tests if not isinstance(test, ForeignKey)]
    if not tests:
        return None
    parts = list(dict.fromkeys(c for test in tests if isinstance(test, Keys) for c in test.columns))

    def entry(number: int, own: Sequence[str], applies: Column) -> Column:
        key = [(F.col(c) if c in own else F.lit(None).cast(df.schema[c].dataType)).alias(f"key_{i}") for i, c in enumerate(parts)]
        return F.when(applies, F.struct(F.lit(number).alias("number"), *key))

    entries = []
    for number, test in enumerate(tests):
        match test:
            case Rule():
                entries.append(entry(number, (), F.expr(test.broken)))
            case Count():
                entries.append(entry(number, (), F.expr(test.counted)))
            case Keys():
                whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in test.columns], F.expr(test.where or "true"))
                entries.append(entry(number, test.columns, whole))
    keys = ["number", *[f"key_{i}" for i in range(len(parts))]]
    each = df.select(F.inline(F.array_compact(F.array(*entries))))
    per_key = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    per_test = per_key.groupBy("number").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("repeated")
    )
    names = F.array(*[F.lit(test.test) for test in tests])
    return per_test.select(F.lit(model).alias("model"), names[F.col("number")].alias("test"), "n", "keys", "repeated")


def orphan_keys(models: Mapping[str, DataFrame], suites: Mapping[str, Suite]) -> DataFrame:
    """(model, test, key, n_rows): every key without a parent row, of every foreign key declared.

    Keys of all children and parents form one stream of (parent, key, slot), where slot -1 is
    the parent itself and the others count the foreign keys on that parent. One grouping by
    (parent, key) tells which keys have a parent row and how often each child names them.
    ``key`` is the key's parts as text.
    """
    links = [(model, test) for model, suite in suites.items() for test in suite.tests if isinstance(test, ForeignKey)]
    parents = list(dict.fromkeys((test.parent, tuple(p for _, p in test.pairs)) for _, test in links))
    slots: dict[int, list[tuple[str, ForeignKey]]] = {number: [] for number in range(len(parents))}
    for model, test in links:
        slots[parents.index((test.parent, tuple(p for _, p in test.pairs)))].append((model, test))
    width = max(len(columns) for _, columns in parents)
    entries: dict[str, list[Column]] = {}
    for number, (parent, columns) in enumerate(parents):
        kinds = [models[parent].schema[c].dataType for c in columns]
        own = [_text(F.col(c), kind, kind) for c, kind in zip(columns, kinds, strict=True)]
        entries.setdefault(parent, []).append(F.array(_link(number, own, width, -1)))
        for slot, (model, test) in enumerate(slots[number]):
            entries.setdefault(model, []).append(_child(models[model].schema, test, kinds, number, width, slot))
    streams = [
        models[model].select(F.inline(F.array_compact(F.flatten(F.array(*found))))) for model, found in entries.items()
    ]
    key = [f"key_{i}" for i in range(width)]
    most = max(len(found) for found in slots.values())
    grouped = (
        reduce(DataFrame.unionAll, streams)
        .groupBy("parent", *key)
        .agg(
            F.max(F.col("slot") == -1).alias("present"),
            *[F.count_if(F.col("slot") == slot).alias(f"n_{slot}") for slot in range(most)],
        )
        .where(~F.col("present"))
    )
    # Names by position: the parent's number, then the slot.
    place = [found[slot] if slot < len(found) else None for found in slots.values() for slot in range(most)]
    model_of = F.array(*[F.lit(p and p[0]).cast("string") for p in place])
    test_of = F.array(*[F.lit(p and p[1].test).cast("string") for p in place])
    counts = F.array(*[F.when(F.col(f"n_{s}") > 0, F.struct(F.lit(s).alias("slot"), F.col(f"n_{s}").alias("n_rows"))) for s in range(most)])
    orphans = grouped.select("parent", F.array_compact(F.array(*key)).alias("key"), F.inline(F.array_compact(counts)))
    at = F.col("parent") * most + F.col("slot")
    return orphans.select(model_of[at].alias("model"), test_of[at].alias("test"), "key", "n_rows")


def _link(parent: int, key: Sequence[Column], width: int, slot: int) -> Column:
    """One element of the stream; NULL if a part of the key is."""
    padded = [*key, *[F.lit(None).cast("string")] * (width - len(key))]
    whole = reduce(Column.__and__, [part.isNotNull() for part in key])
    return F.when(
        whole,
        F.struct(F.lit(parent).alias("parent"), *[p.alias(f"key_{i}") for i, p in enumerate(padded)], F.lit(slot).alias("slot")),
    )


def _child(schema: T.StructType, test: ForeignKey, kinds: Sequence[T.DataType], parent: int, width: int, slot: int) -> Column:
    def parts(element: Column | None) -> list[Column]:
        found = []
        for (column, _), kind in zip(test.pairs, kinds, strict=True):
            own = schema[column].dataType
            if column == test.array:
                found.append(_text(element, own.elementType, kind))
            else:
                found.append(_text(F.col(column), own, kind))
        return found

    if test.array is None:
        return F.array(_link(parent, parts(None), width, slot))
    links = F.transform(test.array, lambda element: _link(parent, parts(element), width, slot))
    return F.coalesce(links, F.array().cast(_link_type(width)))


def _link_type(width: int) -> T.ArrayType:
    parts = ", ".join(f"key_{i}: string" for i in range(width))
    return T.DataType.fromDDL(f"array<struct<parent: int, {parts}, slot: int>>")


def _text(value: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A key part as text. Types must be the parent's, up to the width of whole numbers."""
    whole = isinstance(own, T.IntegralType) and isinstance(wanted, T.IntegralType)
    if isinstance(own, T.FractionalType) and not isinstance(own, T.DecimalType) or not (whole or own == wanted):
        raise ValueError(f"a key part is {own.simpleString()}, its parent {wanted.simpleString()}")
    return F.hex(value) if isinstance(own, T.BinaryType) else value.cast("string")
