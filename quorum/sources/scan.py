"""Windowed scans on a source's own time column.

A run covers ``[start - grace, end]`` on the source's time column, inclusive at both
ends.  Bounds are literals, so Catalyst folds the interval arithmetic and the predicate
is pushed into the Parquet reader (row-group min/max skipping, partition pruning when the
table is partitioned by date).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.functions.timefns import ntz, shift


@dataclass(frozen=True)
class RunWindow:
    """Processing window of one incremental run (wall clock, zone-free)."""

    start: dt.datetime
    end: dt.datetime

    @staticmethod
    def of(start: str | dt.datetime, end: str | dt.datetime) -> "RunWindow":
        def p(v):
            return v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(str(v))
        return RunWindow(p(start), p(end))

    @staticmethod
    def backfill() -> "RunWindow":
        """A first run over the whole history (every row of the inputs)."""
        return RunWindow(dt.datetime(1970, 1, 1), dt.datetime(9999, 12, 30))


def in_window(ts: Column, window: RunWindow, grace: str | None = None) -> Column:
    """ts BETWEEN start - grace AND end (both ends inclusive)."""
    return (ts >= shift(ntz(window.start), grace, -1)) & (ts <= ntz(window.end))


DAY = "day"  # partition column of day-partitioned datasets (date of the time column)


def day_prune(df: DataFrame, window: RunWindow, grace: str | None = None,
              whole_seconds: bool = False) -> Column | None:
    """For a dataset partitioned by ``day`` (the date of its time column), the partition
    predicate implied by the run window -- lets the reader skip whole day folders."""
    if DAY not in df.columns:
        return None
    lo = F.to_date(shift(ntz(window.start), grace, -1))
    hi = F.to_date(ntz(window.end) + F.expr("INTERVAL 1 SECOND")) if whole_seconds \
        else F.to_date(ntz(window.end))
    return F.col(DAY).between(lo, hi)


def in_window_whole_seconds(ts: Column, window: RunWindow) -> Column:
    """trunc_to_second(ts) BETWEEN start AND end, written without a function around the
    column so that it stays pushable: ts >= start AND ts < end + 1 second."""
    return (ts >= ntz(window.start)) & (ts < ntz(window.end) + F.expr("INTERVAL 1 SECOND"))
