"""Time helpers: zone-free timestamp literals and interval arithmetic.

All event times are ``timestamp_ntz`` (wall clock, UTC by convention).  Literals are built
from strings so that neither the Python process' zone nor the session zone leaks in, and
interval arithmetic on literals is constant-folded by Catalyst, so the bounds reach the
Parquet reader as plain pushed filters.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVAL = re.compile(r"^\s*(\d+)\s+(SECOND|MINUTE|HOUR|DAY|WEEK|MONTH|YEAR)S?\s*$", re.I)


def ntz(value) -> Column:
    """A timestamp_ntz literal from a datetime or an ISO-ish string."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def interval(spec: str) -> Column:
    """'1 DAY', '5 MINUTE', '1 MONTH' ... as an interval literal column."""
    m = _INTERVAL.match(spec)
    if not m:
        raise ValueError(f"unsupported interval: {spec!r}")
    n, unit = int(m.group(1)), m.group(2).upper()
    return F.expr(f"INTERVAL {n} {unit}")


_LONGEST = {"SECOND": dt.timedelta(seconds=1), "MINUTE": dt.timedelta(minutes=1), "HOUR": dt.timedelta(hours=1),
            "DAY": dt.timedelta(days=1), "WEEK": dt.timedelta(days=7), "MONTH": dt.timedelta(days=31), "YEAR": dt.timedelta(days=366)}


def longest(spec: str | None) -> dt.timedelta:
    """The most time that an interval text can stand for (a month: 31 days)."""
    if not spec:
        return dt.timedelta(0)
    m = _INTERVAL.match(spec)
    if not m:
        raise ValueError(f"unsupported interval: {spec!r}")
    return int(m.group(1)) * _LONGEST[m.group(2).upper()]


def shift(ts: Column, spec: str | None, sign: int = 1) -> Column:
    """ts +/- interval; month arithmetic clamps to the month end (Jan 31 + 1 month = Feb 29)."""
    if not spec:
        return ts
    return ts + interval(spec) if sign >= 0 else ts - interval(spec)


def truncate_to_second(c) -> Column:
    """Without the fraction of a second; no step passes through the session's time zone."""
    c = F.col(c) if isinstance(c, str) else c
    return c - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), c) % 1)


def format_ts(c) -> Column:
    """Display form 'YYYY-MM-DD HH:MM:SS' (timestamps stay typed everywhere else)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(truncate_to_second(c).cast("string"), 1, 19)


def parse_ts_or_null(value) -> Column:
    """Best-effort parse of a timestamp text to timestamp_ntz; NULL when unparsable."""
    c = value if isinstance(value, Column) else F.lit(str(value))
    return c.try_cast("timestamp_ntz")
