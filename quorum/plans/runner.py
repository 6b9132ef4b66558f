"""One incremental run, and replays of many.

``run_model`` = resolve window -> build the job lazily -> append the result as a new run
partition of the output table -> append the commit row to the metadata table.  Data is
written before the commit, so a run that dies mid-way is simply re-run: it resolves the
same window again and overwrites its own partial output.  A run's folder is named by its
wall clock and its window, so a run never overwrites another window's committed output,
however often a scheduler calls with the same ``now``; a call that finds nothing left to
read writes nothing.  A run with a read cap commits the end of what it read.  Both tables
live under a shared folder (on a cluster: the one ``spark.checkpoint.dir`` names), never on
an executor's local disk.
"""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.functions.timefns import longest, ntz
from quorum.operators.versioned import append, read_current, replace_scope
from quorum.operators.states import append_states, read_states
from quorum.plans.models import MODELS, Model
from quorum.plans.runwindow import META_DDL, commit_rows, empty_meta, resolve_windows
from quorum.plans.tables import Sources
from quorum.sources.scan import RunWindow, in_window


def read_meta(spark: SparkSession, meta_path: str) -> DataFrame:
    """All commit rows under ``meta_path`` (one folder per model and run); empty when the
    table does not exist yet."""
    try:
        return (spark.read.schema(META_DDL).option("recursiveFileLookup", "true")
                .parquet(meta_path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty_meta(spark)
        raise


def _compact_ts(value) -> str:
    return re.sub(r"[-: ]", "", str(value))


def run_id(now, window: RunWindow) -> str:
    """Name of a run: wall clock, window end, window start.

    It sorts by the wall clock and then by the window, so of two catch-up runs at one
    ``now`` the later window's rows are the newer version."""
    return f"run-{_compact_ts(now)}-{_compact_ts(window.end)}-{_compact_ts(window.start)}"


def write_commit(spark: SparkSession, model: str, now, committed, meta_path: str, name: str) -> None:
    """Append a commit as its own folder: concurrent runs of different models never share
    an output committer's working folder."""
    row = spark.createDataFrame([(model, committed)], "model string, next_last_run timestamp_ntz")
    commit_rows(row, now).coalesce(1).write.mode("overwrite").parquet(os.path.join(meta_path, model, name))


def run_model(spark: SparkSession, model: Model | str, sources: Sources, table_path: str,
              meta_path: str, now, interval: str | None = None,
              read_cap: str | None = None, state_path: str | None = None,
              **options) -> tuple[RunWindow, dt.datetime]:
    """One incremental run of ``model`` at wall-clock ``now``; returns (window, committed).

    The window is resolved once; what was read is what is committed.  With ``state_path`` a
    model of mergeable groups keeps their partials there: groups that the window touches are
    finished from all stored partials, so no window edge cuts a rollup."""
    m = MODELS[model] if isinstance(model, str) else model
    interval = interval or m.interval
    meta = read_meta(spark, meta_path)
    windows = resolve_windows(spark.createDataFrame([(m.name,)], "model string"),
                              meta.filter(F.col("model") == m.name), now, interval, read_cap)
    row = windows.first()
    window = RunWindow(row["start_time"], row["end_time"])
    if window.start >= window.end:      # everything up to now is committed
        return window, window.end
    name = run_id(now, window)
    if state_path is not None:
        out = merged_run(spark, m, sources, window, now, state_path, name)
    else:
        out = m.build(sources, window, now, **options)
    if m.recomputes:
        # the run yields every row of its window: what it no longer yields is withdrawn
        grace = options.get("grace", m.grace)
        first, last = window.start - longest(grace), window.end
        replace_scope(out, table_path, m.key, lambda rows: rows.filter(in_window(F.col(m.recomputes), window, grace)),
                      ntz(now), shard=m.shard, order_by=m.key, run_id=name, day_col=m.day_col,
                      days=lambda d: d is not None and first.date() <= d <= last.date())
    else:
        append(out, table_path, key=m.shard, order_by=m.key, run_id=name, day_col=m.day_col)
    write_commit(spark, m.name, now, window.end, meta_path, name)
    return window, window.end


def merged_run(spark: SparkSession, model: Model | str, sources: Sources, window: RunWindow, now,
               state_path: str, run_id: str) -> DataFrame:
    """Store the window's partial groups as run ``run_id``; the finished rows of the groups
    they belong to, over all runs.  Reads the window of the source and the state, no history."""
    m = MODELS[model] if isinstance(model, str) else model
    if m.merges is None:
        raise ValueError(f"{m.name} keeps no mergeable state")
    kept = m.merges
    append_states(kept.of_window(sources, window), state_path, kept.on, run_id, kept.key)
    return kept.finish(read_states(spark, state_path, kept.key, kept.minima, kept.on, touched_by=run_id), now)


def replay(spark: SparkSession, model: Model | str, sources: Sources, root: str, nows,
           interval: str | None = None, read_cap: str | None = None,
           **options) -> DataFrame:
    """Run ``model`` at each of ``nows`` in turn; return the current rows of its table."""
    m = MODELS[model] if isinstance(model, str) else model
    table_path, meta_path = os.path.join(root, m.name), os.path.join(root, "model_metadata")
    for now in nows:
        run_model(spark, m, sources, table_path, meta_path, now, interval, read_cap, **options)
    return read_current(spark, table_path, key=m.key, version=("updated_at",))


def run_models(spark: SparkSession, models, sources: Sources, root: str, now,
               threads: int = 4, read_cap: str | None = None) -> dict:
    """Run several independent models concurrently (the source system runs 4 at a time).

    Each model's actions are submitted from its own driver thread into its own scheduler
    pool (``spark.scheduler.pool``), so with ``spark.scheduler.mode=FAIR`` a long model
    cannot starve the others; Spark interleaves their stages on the same executors.
    Returns {model: (window, committed)}; a failing model does not stop the others and
    is reported as its exception.
    """
    from concurrent.futures import ThreadPoolExecutor

    names = [m if isinstance(m, str) else m.name for m in models]
    meta_path = os.path.join(root, "model_metadata")

    def use_pool(name):
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            pass

    def one(name: str):
        use_pool(name)
        try:
            return run_model(spark, name, sources, os.path.join(root, name), meta_path, now,
                             read_cap=read_cap)
        except Exception as e:  # noqa: BLE001 - reported per model
            return e
        finally:
            use_pool(None)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(zip(names, pool.map(one, names)))
