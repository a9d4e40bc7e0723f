"""Where each raw table comes from, and the run's reference time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialize
from ledgerlens.sources.tables import FileTable, JdbcTable, read_optional

Reader = Callable[[SparkSession], DataFrame]


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores when the source came in fewer pieces (one large file, one connection)."""
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def _narrow(rows: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """``rows`` stored with ``columns`` alone; the others are in the result by name and fail when read."""
    stored = materialize(rows.select(*columns), name)

    def absent(kept: T.StructField) -> Column:
        return F.raise_error(F.lit(f"{name}.{kept.name} is not stored in this run")).cast(kept.dataType).alias(kept.name)

    return stored.select(*[F.col(f.name) if f.name in columns else absent(f) for f in rows.schema])


# Models kept as tables: small dimensions and results that several marts read.
STORED = frozenset(
    {
        "chain",
        "token",
        "product_classic",
        "product_clm",
        "product_reward_pool",
        "product_classic_boost",
        "product",
        "account",
        "product_stats",
    }
)


@dataclass
class Warehouse:
    """Raw tables by name plus everything that would otherwise be a wall-clock call.

    ``raw`` maps a table name to a reader, a table description or a DataFrame.
    ``renames`` maps a table name to {source column: column the plans expect}, for
    deployments whose raw columns are named differently.
    """

    spark: SparkSession
    as_of: datetime
    raw: Mapping[str, Reader | FileTable | JdbcTable | DataFrame]
    renames: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    buyback_symbol: str = "TKN"
    fee_leg: str = "protocol_fee"
    stored: frozenset[str] = STORED
    land_raw: bool = False
    spread: frozenset[str] = frozenset()
    in_place: frozenset[str] = frozenset()
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    _plans: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _tables: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        """A raw table under the plans' column names.

        With ``land_raw`` it is first copied to the shared folder, so a database
        or a costly reader is read once and not by every model. Tables named in
        ``spread`` are written in at least as many pieces as there are cores, those
        in ``in_place`` are not copied.
        """
        if not self.land_raw or name in self.in_place:
            return self._read(name)
        key = f"raw.{name}"
        if key not in self._tables:
            rows = self._read(name)
            self._tables[key] = materialize(_spread(rows) if name in self.spread else rows, name)
        return self._tables[key]

    def _read(self, name: str) -> DataFrame:
        found = self.raw[name]
        if isinstance(found, FileTable | JdbcTable):
            found = found.read(self.spark)
        elif not isinstance(found, DataFrame):
            found = found(self.spark)
        return found.withColumnsRenamed(dict(self.renames.get(name, {})))

    def optional(self, name: str) -> DataFrame | None:
        found = self.raw.get(name)
        if isinstance(found, FileTable | JdbcTable):
            return read_optional(self.spark, found)
        return None if found is None else self.table(name)

    def model(self, build: Callable[[Warehouse], DataFrame]) -> DataFrame:
        """The model, built once per warehouse so every user shares it.

        Stored models are written to the shared folder on first use and read from
        there afterwards; the others are plans that Catalyst inlines. A model named
        in ``columns`` is stored with these columns alone, and what only the others
        need is not computed: they keep their place, but a query that reads one fails.
        """
        key = f"{build.__module__}.{build.__qualname__}"
        if key in self._tables:
            return self._tables[key]
        if build.__name__ in self.columns:
            self._tables[key] = _narrow(build(self), self.columns[build.__name__], build.__name__)
            return self._tables[key]
        if build.__name__ in self.stored:
            self._tables[key] = materialize(build(self), build.__name__)
            return self._tables[key]
        if key not in self._plans:
            self._plans[key] = build(self)
        return self._plans[key]

    def part(self, build: Callable[[Warehouse], DataFrame]) -> DataFrame:
        """The model for a reader of few of its rows or columns: the stored table if there is one, else the plan.

        What the reader leaves out is then left out before shuffles, and nothing is stored for it.
        """
        key = f"{build.__module__}.{build.__qualname__}"
        if key in self._tables:
            return self._tables[key]
        if key not in self._plans:
            self._plans[key] = build(self)
        return self._plans[key]

    def at(self, as_of: datetime) -> Warehouse:
        """The same warehouse and stored tables seen from another reference time."""
        return replace(self, as_of=as_of, _plans={})

    def pin(self, build: Callable[[Warehouse], DataFrame], stored: DataFrame) -> None:
        """Use a stored table in place of a model's plan from here on."""
        self._tables[f"{build.__module__}.{build.__qualname__}"] = stored
