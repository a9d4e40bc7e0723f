"""The data-test kinds.

Every function takes the tested DataFrame first and returns violations as a
DataFrame. ``row_checks`` counts many row-level rules in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.joins import anti_join_keys


def _only(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(F.expr(where)) if where else df


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return _only(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """Key tuples that occur more than once, with their count; tuples with a NULL are ignored."""
    rows = _only(df, where).dropna(subset=list(columns))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_range(df: DataFrame, column: str, low: Any = None, high: Any = None) -> DataFrame:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return df.where(outside)


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def relationship(df: DataFrame, parent: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Rows whose key (all parts present) has no parent row."""
    return anti_join_keys(df.dropna(subset=list(pairs)), parent, list(pairs.items()))


def relationship_array(
    df: DataFrame, array: str, parent: DataFrame, parent_key: str, shared: Mapping[str, str] | None = None
) -> DataFrame:
    """Array elements, optionally with shared key columns, that have no parent row."""
    shared = dict(shared or {})
    elements = df.select(*shared, F.explode(array).alias("element"))
    return relationship(elements, parent, {**shared, "element": parent_key})


def array_length(
    df: DataFrame, column: str, low: int, high: int, where: str | None = None
) -> DataFrame:
    size = F.coalesce(F.size(column), F.lit(0))
    return _only(df, where).where(~size.between(low, high))


def expression(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the SQL condition is not true."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def exactly_one_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).where("row_count <> 1")


def date_exists(df: DataFrame, column: str, as_of: date, days_ago: int) -> DataFrame:
    """One row when no row falls on the day ``days_ago`` before ``as_of``."""
    day = F.lit(as_of - timedelta(days=days_ago))
    hits = F.count(F.when(F.to_date(column) == day, F.lit(1)))
    return df.agg(hits.alias("row_count")).where("row_count = 0")


def distinct_count_above(df: DataFrame, column: str, minimum: int) -> DataFrame:
    return df.agg(F.count_distinct(F.col(column)).alias("distinct_count")).where(
        F.col("distinct_count") <= minimum
    )


def _hex_rule(text: Column, bytes_length: int | None) -> Column:
    ok = text.rlike("^0x([0-9a-fA-F]{2})+$")
    if bytes_length is not None:
        ok = ok & (F.length(text) == 2 + 2 * bytes_length)
    return ok


def hex_string(df: DataFrame, column: str, bytes_length: int | None = None) -> DataFrame:
    """Values that are not ``0x`` hex text (of the given byte length)."""
    return df.where(~_hex_rule(F.col(column), bytes_length))


def bytes_string(df: DataFrame, column: str, bytes_length: int | None = None) -> DataFrame:
    """Binary values that are empty or not of the given byte length."""
    text = F.concat(F.lit("0x"), F.hex(column))
    return df.where(~_hex_rule(text, bytes_length))


def hex_matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Binary values whose lowercase ``0x`` form does not match the pattern."""
    return df.where(~F.concat(F.lit("0x"), F.lower(F.hex(column))).rlike(pattern))


def contract_differences(
    schema: T.StructType, declared: Mapping[str, str]
) -> list[tuple[str, str | None, str | None]]:
    """(column, declared type, actual type) where the two differ; None where one has no such column."""
    actual = {column.name: column.dataType.simpleString() for column in schema}
    wanted = {name: T.DataType.fromDDL(kind).simpleString() for name, kind in declared.items()}
    return [
        (name, wanted.get(name), actual.get(name))
        for name in dict.fromkeys([*wanted, *actual])
        if wanted.get(name) != actual.get(name)
    ]


def contract(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Columns that are missing, undeclared or of another type (a driver-side schema comparison)."""
    return df.sparkSession.createDataFrame(
        contract_differences(df.schema, declared),
        "column_name string, declared string, actual string",
    )


def row_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violation counts of many row rules in a single pass, one row per rule.

    A rule is the condition a row must meet; a NULL outcome counts as a
    violation.
    """
    counts = df.agg(
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules]
    )
    return counts.select(F.explode(pairs).alias("_r")).select("_r.rule", "_r.violations")
