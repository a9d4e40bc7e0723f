"""Cursors and bounded windows for scheduled micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGINNING = datetime(1900, 1, 1)


def max_time(target: DataFrame | None, ts: str, default: datetime | None = None) -> datetime | None:
    """Greatest time in the target, or ``default`` when it is missing or empty."""
    if target is None:
        return default
    found = target.agg(F.max(F.col(ts).cast("timestamp_ntz"))).first()[0]
    return found if found is not None else default


def lookback_start(target: DataFrame | None, ts: str, days: int = 1) -> datetime:
    """Start of the rows to reprocess: ``days`` before the newest stored row."""
    newest = max_time(target, ts)
    return newest - timedelta(days=days) if newest else BEGINNING


def lookback_starts(
    target: DataFrame | None, tag: str, ts: str, tags: Iterable[str], days: int = 1
) -> dict[str, datetime]:
    """One start per known source tag, from a single aggregate over the target."""
    tags = list(tags)
    if target is None:
        return dict.fromkeys(tags, BEGINNING)
    newest = target.agg(
        *[F.max(F.when(F.col(tag) == t, F.col(ts).cast("timestamp_ntz"))).alias(t) for t in tags]
    ).first()
    return {t: newest[t] - timedelta(days=days) if newest[t] else BEGINNING for t in tags}


def new_rows(df: DataFrame, ts: str, start: datetime, as_of: datetime) -> DataFrame:
    """Rows from ``start`` on, up to one day past ``as_of``; literal bounds reach the scan."""
    return df.where(
        (F.col(ts) >= F.lit(str(start)).cast("timestamp_ntz"))
        & (F.col(ts) < F.lit(str(as_of + timedelta(days=1))).cast("timestamp_ntz"))
    )


def new_rows_per_source(
    df: DataFrame, tag: str, ts: str, starts: dict[str, datetime], as_of: datetime
) -> DataFrame:
    """The same with one start per source tag; unknown tags are dropped."""
    wanted = F.lit(False)
    for name, start in starts.items():
        wanted = wanted | (
            (F.col(tag) == name) & (F.col(ts) >= F.lit(str(start)).cast("timestamp_ntz"))
        )
    return df.where(wanted & (F.col(ts) < F.lit(str(as_of + timedelta(days=1))).cast("timestamp_ntz")))


def add_month(at: datetime) -> datetime:
    """Same day next month, or its last day."""
    year, month = (at.year + 1, 1) if at.month == 12 else (at.year, at.month + 1)
    for day in (at.day, 30, 29, 28):
        try:
            return at.replace(year=year, month=month, day=day)
        except ValueError:
            continue
    raise AssertionError("unreachable")


def catch_up_window(start: datetime, as_of: datetime, lag_days: int = 7) -> tuple[datetime, datetime]:
    """One run's half-open window: a month at most, ending ``lag_days`` before ``as_of``."""
    return start, min(add_month(start), as_of - timedelta(days=lag_days))


def catch_up(
    start: datetime, as_of: datetime, step: Callable[[datetime, datetime], None], lag_days: int = 7
) -> int:
    """Runs ``step(start, end)`` month by month until the lag is reached; returns the number of runs."""
    runs = 0
    while True:
        low, high = catch_up_window(start, as_of, lag_days)
        if high <= low:
            return runs
        step(low, high)
        runs += 1
        start = high


def backfill(
    load: Callable[[datetime], int], start: datetime, until: datetime, days: int = 120
) -> int:
    """Loads consecutive windows of ``days`` until the end of data is passed.

    ``load(start)`` returns how many rows it stored. An empty window before
    ``until`` does not end the run, so a gap longer than a window is crossed.
    """
    total = 0
    while start < until:
        total += load(start)
        start += timedelta(days=days)
    return total
