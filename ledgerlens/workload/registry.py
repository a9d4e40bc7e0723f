"""All registered queries and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.workload import (
    declared_queries,
    function_queries,
    io_queries,
    model_queries,
    operator_queries,
    staging_queries,
)

_MODULES = (io_queries, operator_queries, function_queries, staging_queries, model_queries, declared_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in _MODULES for name, run in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.oracles().items()}
