"""Run-window resolution and commit.

The run metadata table is ``(model, updated_date_time, last_run_date_time)``, appended to
after every successful load.  For a model and a run start ``now``:

* never ran            -> read [now - interval, now], commit now
* ran, last run = L    -> read [L, least(L + read_cap, now)], commit least(L + interval, now)

``read_cap`` defaults to ``None``: the read end equals the committed value, so a catch-up
after a pause reads exactly what it commits.  ``read_cap='1 HOUR'`` reproduces the
source system, whose read end is capped at one hour while the commit advances by the full
interval (data between the two is never read).

Everything is a DataFrame expression over the metadata table; ``resolve_window``
computes the one row of one model (a single-row aggregate) and hands the values to the
driver, because the driver needs them to build the scan filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.functions.timefns import format_ts, parse_ts_or_null, shift, truncate_to_second
from quorum.sources.scan import RunWindow

META_DDL = "model string, updated_date_time timestamp_ntz, last_run_date_time timestamp_ntz"


def resolve_windows(models: DataFrame, meta: DataFrame, now, interval: str,
                    read_cap: str | None = None) -> DataFrame:
    """Per model: start_time, end_time (read window) and next_last_run (to commit)."""
    now_c = truncate_to_second(parse_ts_or_null(now))
    last = meta.groupBy("model").agg(F.max("last_run_date_time").alias("last_run"))
    w = models.select("model").distinct().join(last, "model", "left")
    never = F.col("last_run").isNull()
    commit = F.least(shift(F.col("last_run"), interval), now_c)
    read_end = F.least(shift(F.col("last_run"), read_cap), now_c) if read_cap else commit
    return w.select(
        "model",
        F.when(never, shift(now_c, interval, -1)).otherwise(F.col("last_run")).alias("start_time"),
        F.when(never, now_c).otherwise(read_end).alias("end_time"),
        F.when(never, now_c).otherwise(commit).alias("next_last_run"))


def window_text(windows: DataFrame) -> DataFrame:
    """The resolved windows as display text (the form the run log prints)."""
    return windows.select("model", *[format_ts(c).alias(c) for c in
                                     ("start_time", "end_time", "next_last_run")])


def commit_rows(windows: DataFrame, now) -> DataFrame:
    """The metadata rows a successful run appends."""
    return windows.select("model", truncate_to_second(parse_ts_or_null(now)).alias("updated_date_time"),
                          F.col("next_last_run").alias("last_run_date_time"))


def empty_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], META_DDL)


def resolve_window(spark: SparkSession, meta: DataFrame, model: str, now, interval: str,
                   read_cap: str | None = None) -> tuple[RunWindow, dt.datetime]:
    """(read window, value to commit) for one model -- computed once, used for both."""
    models = spark.createDataFrame([(model,)], "model string")
    row = resolve_windows(models, meta.filter(F.col("model") == model), now, interval,
                          read_cap).first()
    return RunWindow(row["start_time"], row["end_time"]), row["next_last_run"]
