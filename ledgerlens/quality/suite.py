"""Named test suites and their outcome."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Outcome:
    table: str
    check: str
    violations: int

    @property
    def passed(self) -> bool:
        return self.violations == 0


def violations_per_check(df: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """One row per check with its number of violating rows, as a single job."""
    counted = [
        check(df).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, check in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def run_suite(tables: Mapping[str, tuple[DataFrame, Mapping[str, Check]]]) -> list[Outcome]:
    outcomes = []
    for table, (df, checks) in tables.items():
        for row in violations_per_check(df, checks).collect():
            outcomes.append(Outcome(table, row["check"], row["violations"]))
    return outcomes
