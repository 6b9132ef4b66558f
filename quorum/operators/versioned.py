"""Replacing tables on an append-only store.

A *replacing* table keeps every appended version of a row; readers see, per key, the
version with the greatest version columns.  Three pieces:

* ``latest_by_key`` -- one row per key, greatest version.  Written as a grouped ``max``
  over a struct (version first, then the remaining columns as a deterministic tie-break).
  Spark plans it as a sort aggregate with a map-side partial: a hot key costs one partial
  row per map task, never a whole group in one task.
* ``append`` -- the sink: rows hashed by (day and) key into files, sorted inside each file
  by (day and) the storage key (row-group min/max skipping), written as the run's own
  ``run_id=<id>`` folder: other runs' files are never touched, and a retried run replaces
  its own partial output.  With ``buckets`` the files are bucketed by these columns, and reads
  of such runs keep that distribution: grouping by the columns needs no exchange.  A one-row
  record under ``_runs`` follows the data and names the run, its schema, days and buckets; only
  recorded runs are read.  So a half-written run is
  invisible, a table whose runs are all empty is readable, and the schema may grow: a read
  has the columns of all live runs, NULL where a run lacked one (a column of two types is an
  error).
* ``replace_scope`` -- the sink of a job that recomputes whole groups (a window, the keys a
  stream batch touched): keys that the table holds in the recomputed scope and the result no
  longer yields are *withdrawn* by a marker row (``_deleted``) of the same run.  Rows whose
  replacing key changes with late data thus leave no stale twin behind.
* ``read_current`` -- read with latest-version semantics; the version is the version columns
  and, among equals, the run; keys whose latest row is a marker are gone.
* ``compact`` folds the runs of every day that has more than its base into a new base for
  these days (a table without days: into one base), and records what it replaces per day.
  Other days are not touched.  Readers list the live (run, day) folders only, nothing is
  rewritten in place, and a compaction that dies leaves no record and changes nothing.
  ``retire`` deletes what compactions replaced.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from quorum.session import delete_path

_ORDERABLE_EXCLUDED = ("map",)
DAY = "day"  # partition column of day-partitioned replacing tables
BASE = "base-"  # prefix of the runs that compaction writes
DELETED = "_deleted"  # marks a row that withdraws its key
RUNS = "_runs"
_RECORD = ("run_id string, schema string, days array<date>, folded array<date>, replaced array<string>, "
           "buckets int, bucketed array<string>")
WHOLE = "whole"  # stands for the days of a table that has none


def _orderable(df: DataFrame, col: str) -> bool:
    return not df.schema[col].dataType.typeName().startswith(_ORDERABLE_EXCLUDED)


def latest_by_key(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``version`` (NULL keys form a group)."""
    key, version = list(key), list(version)
    rest = [c for c in df.columns if c not in key and c not in version]
    tie = [c for c in rest if _orderable(df, c)]
    carried = [c for c in rest if c not in tie]
    fields = version + tie + carried
    packed = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(fields)])
    if carried:
        # map-typed columns cannot take part in an ordering: pick them with max_by instead
        best = F.max_by(packed, F.struct(*[F.col(f"`{c}`") for c in version + tie]))
    else:
        best = F.max(packed)
    out = df.groupBy(*key).agg(best.alias("_best"))
    return out.select(*key, *[F.col(f"_best.v{i}").alias(c) for i, c in enumerate(fields)]) \
              .select(*df.columns)


def append(df: DataFrame, path: str, key: Sequence[str], order_by: Sequence[str] = (),
           run_id: str | None = None, files: int | None = None,
           day_col: str | None = None, bloom: Sequence[str] = (), buckets: Sequence[str] = ()) -> str:
    """Write ``df`` as one new run of the table at ``path``; returns the run id.

    With ``day_col`` (a timestamp column of the replacing key) rows are also partitioned
    by ``day = to_date(day_col)``, so readers restricted to some days prune the others.
    ``bloom`` names columns whose Parquet files get Bloom filters; ``buckets`` (for tables
    without days) the columns that the files are bucketed by, in place of ``key``."""
    run_id = run_id or "run-" + _now()
    if buckets:
        if day_col:
            raise ValueError("a table of days is not bucketed")
        n = _write_buckets(df, path, buckets, order_by, run_id, bloom)
        _record(df.sparkSession, path, Run(run_id, df.schema, None, buckets=n, bucketed=list(buckets)))
        return run_id
    out = df.withColumn(DAY, F.to_date(day_col)) if day_col else df
    days = _write_run(out, path, key, order_by, run_id, files, bloom)
    _record(df.sparkSession, path, Run(run_id, out.schema, days))
    return run_id


def replace_scope(out: DataFrame, path: str, key: Sequence[str], scope: Callable[[DataFrame], DataFrame],
                  stamp: Column, version: str = "updated_at", shard: Sequence[str] = (),
                  order_by: Sequence[str] = (), run_id: str | None = None, day_col: str | None = None,
                  days: Callable[[dt.date | None], bool] | None = None) -> str:
    """Append ``out`` as all that the table holds in a scope; returns the run id.

    ``scope`` keeps the current rows that ``out`` was recomputed for.  Their keys that
    ``out`` does not yield are withdrawn with the version ``stamp``, in the same run, so the
    change is visible as a whole or not at all.  ``days`` (optional) tells which days of a
    day-partitioned table the scope can touch.  One shuffle by the key meets the two sides;
    nothing is computed twice."""
    spark, run_id = out.sparkSession, run_id or "run-" + _now()
    before = _versions(spark, path, keep_day=days, without=run_id)
    rows = out
    if before is not None:
        gone = scope(_current(before, key, (version,)))
        columns = [*key, *([day_col] if day_col and day_col not in key else [])]
        gone = gone.select(*columns, stamp.cast(out.schema[version].dataType).alias(version), F.lit(True).alias(DELETED), F.lit(False).alias("_live"))
        both = out.withColumns({DELETED: F.lit(False), "_live": F.lit(True)}).unionByName(gone, allowMissingColumns=True)
        rows = latest_by_key(both, key, ("_live",)).drop("_live")
    return append(rows, path, shard or key, order_by, run_id, day_col=day_col)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


@dataclass(frozen=True)
class Run:
    """A recorded run.  ``days``: those it holds rows of (None: no days).  A base also has
    the days it was made for (``folded``, None: no days) and the runs it replaces there.
    ``buckets`` and ``bucketed`` are the number and the columns of its buckets, if it has any."""
    run_id: str
    schema: StructType
    days: list[dt.date | None] | None
    folded: list[dt.date | None] | None = None
    replaced: list[str] | None = None
    buckets: int | None = None
    bucketed: list[str] | None = None


def _table() -> str:
    return f"quorum_{uuid.uuid4().hex}"


def _write_buckets(out: DataFrame, path: str, buckets: Sequence[str], order_by: Sequence[str], run_id: str,
                   bloom: Sequence[str] = ()) -> int:
    """Write a run bucketed by ``buckets``, one file per bucket; returns their number.  Spark
    writes buckets to tables only: the external table's name goes at once, its files stay."""
    spark = out.sparkSession
    n, table, folder = int(spark.conf.get("spark.sql.shuffle.partitions")), _table(), _folder(path, (run_id, WHOLE))
    delete_path(spark, folder)      # a retried run replaces its own partial output
    # Spark drops this repartition when the rows were just grouped by the same columns
    writer = out.repartition(*buckets).write.format("parquet").option("path", folder).option("compression", "zstd")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    # filters of the size that a file's values need, not of 1 MB
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true").bucketBy(n, *buckets)
    (writer.sortBy(*order_by) if order_by else writer).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")
    return n


def _read_buckets(spark: SparkSession, path: str, buckets: int, by: Sequence[str], schema: StructType,
                  run_ids: Sequence[str]) -> DataFrame:
    """The bucketed runs ``run_ids`` with their ``run_id``, as one relation whose tasks read a
    bucket of all of them (a union of runs would need an exchange).  Spark knows the buckets of
    tables only, so the folders are one while it is resolved."""
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    table, root = _table(), path.rstrip("/")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folders = "{" + ",".join(f"run_id={r}" for r in run_ids) + "}"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (basePath {quoted(root)}) "
              f"CLUSTERED BY ({', '.join(f'`{c}`' for c in by)}) INTO {buckets} BUCKETS LOCATION {quoted(f'{root}/{folders}')}")
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def _write_run(out: DataFrame, path: str, key: Sequence[str], order_by: Sequence[str], run_id: str,
               files: int | None = None, bloom: Sequence[str] = ()) -> list[dt.date | None] | None:
    lead = [DAY] if DAY in out.columns else []
    rows = out.repartition(files, *lead, *key) if files else out.repartition(*lead, *key)
    if order_by:
        # the partitioned writer needs rows by day: leading with it keeps this sort
        rows = rows.sortWithinPartitions(*lead, *order_by)
    # each run owns its folder: concurrent writers never share a committer's working folder
    folder = f"{path.rstrip('/')}/run_id={run_id}"
    writer = rows.write.partitionBy(DAY) if lead else rows.write
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.mode("overwrite").parquet(folder)
    if not lead:
        return None
    stored = out.sparkSession.read.schema(out.schema).parquet(folder).select(DAY).distinct().collect()
    return [r[0] for r in stored]


def _record(spark: SparkSession, path: str, run: Run) -> None:
    row = (run.run_id, run.schema.json(), run.days, run.folded, run.replaced, run.buckets, run.bucketed)
    spark.createDataFrame([row], _RECORD).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUNS}/{run.run_id}")


def runs(spark: SparkSession, path: str) -> list[Run] | None:
    """The recorded runs, oldest id first (one small row per run since the last ``retire``);
    None for a table that ``append`` did not write."""
    try:
        rows = spark.read.schema(_RECORD).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/{RUNS}").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    found = [Run(r[0], StructType.fromJson(json.loads(r[1])), *r[2:]) for r in rows]
    # a base that nobody recorded as such is left over from a compaction that died
    return sorted((r for r in found if not r.run_id.startswith(BASE) or r.replaced is not None), key=lambda r: r.run_id)


def _parts(run: Run) -> list[tuple[str, object]]:
    return [(run.run_id, d) for d in (run.days if run.days is not None else [WHOLE])]


def live(recorded: Iterable[Run]) -> list[tuple[str, object]]:
    """The (run, day) folders that count: those that no base replaces."""
    recorded = list(recorded)
    dead = {(r, d) for run in recorded if run.replaced is not None
            for d in (run.folded if run.folded is not None else [WHOLE]) for r in run.replaced}
    return [p for run in recorded for p in _parts(run) if p not in dead]


def _folder(path: str, part: tuple[str, object]) -> str:
    run_id, day = part
    folder = f"{path.rstrip('/')}/run_id={run_id}"
    return folder if day == WHOLE else f"{folder}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def merged_schema(recorded: Iterable[Run]) -> StructType:
    """The columns of all runs, in the order they came; one column of two types is an error."""
    fields: dict[str, StructField] = {}
    for run in recorded:
        for f in run.schema.fields:
            known = fields.setdefault(f.name, StructField(f.name, f.dataType, True))
            if known.dataType.simpleString() != f.dataType.simpleString():
                raise ValueError(f"column {f.name} is {known.dataType.simpleString()} in earlier runs and "
                                 f"{f.dataType.simpleString()} in {run.run_id}")
    return StructType(list(fields.values()))


def _read_parts(spark: SparkSession, path: str, recorded: list[Run], parts: Sequence[tuple[str, object]]) -> DataFrame:
    """The rows of some folders with ``run_id`` (and ``day``) columns."""
    schema = merged_schema(recorded)
    days = [StructField(DAY, DateType())] if DAY in schema.names else []
    schema = StructType([f for f in schema.fields if f.name != DAY] + [StructField("run_id", StringType())] + days)
    if not parts:
        return spark.createDataFrame([], schema)
    layouts = {r.run_id: (r.buckets, *r.bucketed) for r in recorded if r.buckets}
    by_layout: dict[tuple, list[tuple[str, object]]] = {}
    for part in parts:
        by_layout.setdefault(layouts.get(part[0], ()), []).append(part)
    frames = [_read_buckets(spark, path, layout[0], layout[1:], schema, [r for r, _ in some]) if layout
              else spark.read.schema(schema).option("basePath", path).parquet(*(_folder(path, p) for p in some))
              for layout, some in by_layout.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _versions(spark: SparkSession, path: str, keep_day: Callable[[dt.date | None], bool] | None = None,
              without: str | None = None) -> DataFrame | None:
    """Every stored version that counts, with its ``run_id``; only live folders are listed.
    None for a table that ``append`` did not write (or wrote nothing but run ``without``)."""
    recorded = [r for r in runs(spark, path) or [] if r.run_id != without]
    if not recorded:
        return None
    parts = [p for p in live(recorded) if keep_day is None or p[1] == WHOLE or keep_day(p[1])]
    return _read_parts(spark, path, recorded, parts)


def _current(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Latest version per key of ``_versions``; of equal versions the newer run's row (a
    base is older than every run that it does not replace).  Withdrawn keys are left out."""
    if "run_id" in df.columns:
        run = F.when(F.col("run_id").startswith(BASE), F.lit("")).otherwise(F.col("run_id"))
        df = latest_by_key(df.withColumn("run_id", run), key, [*version, "run_id"]).drop("run_id")
    else:
        df = latest_by_key(df, key, version)
    if DELETED in df.columns:
        df = df.filter(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)
    return df


def read_current(spark: SparkSession, path: str, key: Sequence[str],
                 version: Sequence[str] = ("updated_at",), days=None) -> DataFrame:
    """Read a replacing table: latest version per key.  ``days`` (optional) restricts a
    day-partitioned table before the dedupe -- partition pruning, exact because every
    version of a key lies in its day."""
    wanted = None if days is None else {d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in days}
    df = _versions(spark, path, keep_day=None if wanted is None else wanted.__contains__)
    if df is None:
        df = spark.read.parquet(path)
    if wanted is not None:
        if DAY not in df.columns:
            raise ValueError(f"{path} is not partitioned by day")
        df = df.filter(F.col(DAY).isin([F.lit(d).cast("date") for d in sorted(wanted)]))
    return _current(df.drop(DAY), key, version)


def current_rows(table: DataFrame, key: Sequence[str],
                 version: Sequence[str] = ("updated_at",)) -> DataFrame:
    """``read_current`` for a table that is already a DataFrame (e.g. a union of runs)."""
    return latest_by_key(table.drop("run_id", DAY), key, version)


def compact(spark: SparkSession, path: str, key: Sequence[str],
            version: Sequence[str] = ("updated_at",), order_by: Sequence[str] = (),
            fold: Callable[[DataFrame], DataFrame] | None = None, bloom: Sequence[str] = (),
            buckets: Sequence[str] = ()) -> str | None:
    """Fold the runs of ``path`` into a base run; returns its id (None: nothing to fold).

    Of a day-partitioned table only the days that hold more than a base are read and
    written.  The runs to fold are listed first; runs that finish meanwhile stay as they are
    and are read beside the base.  ``fold`` makes the base's rows of the stored ones (latest
    versions unless given; a table of partial states merges them)."""
    recorded = runs(spark, path)
    if recorded is None:
        raise ValueError(f"{path} was not written by append")
    by_day: dict[object, list[str]] = {}
    for run_id, day in live(recorded):
        by_day.setdefault(day, []).append(run_id)
    days = [d for d, ids in by_day.items() if len(ids) > 1 or not ids[0].startswith(BASE)]
    parts = [(r, d) for d in days for r in by_day[d]]
    if not parts:
        return None
    stored = _read_parts(spark, path, recorded, parts)
    if stored.isEmpty():
        return None
    base = BASE + _now()
    rows = fold(stored.drop("run_id")) if fold else _current(stored, key, version)
    n = _write_buckets(rows, path, buckets, order_by, base, bloom) if buckets else None
    kept = None if buckets else _write_run(rows, path, key, order_by, base, bloom=bloom)
    _record(spark, path, Run(base, rows.schema, kept, None if days == [WHOLE] else days,
                             sorted({r for r, _ in parts}), n, list(buckets) or None))
    return base


def retire(spark: SparkSession, path: str, before: dt.datetime | None = None) -> int:
    """Delete the folders that bases replaced; returns their number.

    ``before`` (UTC, optional) spares what bases made later replaced, for readers that
    planned on the older folders.  A record goes before its data, and a base's record stays as
    long as one of a run that it replaces, so a job that dies leaves a table that reads the
    same."""
    recorded = runs(spark, path) or []
    settled = [r for r in recorded if r.replaced is None or before is None
               or r.run_id < BASE + before.strftime("%Y%m%dT%H%M%S%f")]
    alive = set(live(settled))
    kept = {r.run_id for r in recorded}
    count = 0
    for run in sorted(settled, key=lambda r: (r.replaced is not None, r.run_id)):
        dead = [p for p in _parts(run) if p not in alive]
        if dead and len(dead) == len(_parts(run)) and not kept.intersection(run.replaced or ()):
            delete_path(spark, f"{path.rstrip('/')}/{RUNS}/{run.run_id}")
            kept.remove(run.run_id)
        for part in dead:
            delete_path(spark, _folder(path, part))
        count += len(dead)
    return count


def compact_bucketed(spark: SparkSession, path: str, table: str, key: Sequence[str],
                     buckets: int, version: Sequence[str] = ("updated_at",),
                     order_by: Sequence[str] = ()) -> str:
    """Write the current rows of ``path`` as a catalog table bucketed (and sorted) by the
    key.  Later latest-version reads and joins on the key need no shuffle: the scan
    already delivers rows hash-partitioned by it."""
    current = read_current(spark, path, key, version)
    w = current.write.mode("overwrite").format("parquet").bucketBy(buckets, *key)
    if order_by:
        w = w.sortBy(*order_by)
    w.saveAsTable(table)
    return table
