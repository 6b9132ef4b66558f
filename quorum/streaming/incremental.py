"""T1 / T2 / T3 / T4 with Structured Streaming.

Exact distinct counts, unions of joins and nearest joins are no streaming operators, so the
streams of such jobs drive *recomputation*: every micro-batch names the keys it touched
(e.g. (slot, network)) and the days their rows lie on, and ``foreachBatch`` recomputes
exactly those keys from these days of the base tables, then hands the result to the
replacing output table as all that it holds of these keys.  Late rows are therefore never
dropped (a late row touches its key again and the newer result supersedes the older one on
read), a row that a late one displaces is withdrawn, and the stream's checkpoint plus the
idempotent sink give effectively-once output: a batch that is replayed after a failure
rewrites its own run.

Jobs whose result is a least row per group or a distinct set are streaming operators:
``first_per_group_stream`` and ``distinct_stream`` keep their state in Spark's state store.
``tumbling_counts`` counts event-time tumbling windows with a watermark; the same function
is used for batch DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.operators.ranking import first_per_group
from quorum.operators.versioned import append, replace_scope


def recompute_touched(touched: DataFrame, keys: Sequence[str],
                      build: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
    """Run ``build`` with a restriction that semi-joins each input to the touched keys."""
    keys = list(keys)
    touched = touched.select(*keys).distinct()

    def restrict(df: DataFrame) -> DataFrame:
        return df.join(touched, keys, "left_semi")

    return build(restrict)


def touched_days(touched: DataFrame, start: str, length: dt.timedelta) -> list[dt.date]:
    """The days on which rows of the touched keys can lie: from each key's start to
    ``length`` beyond it.  One distinct over dates, as many as the calendar has days."""
    last = F.col(start) + F.make_dt_interval(secs=F.lit(length.total_seconds() - 1e-6))
    days = touched.filter(F.col(start).isNotNull()) \
        .select(F.explode(F.sequence(F.to_date(start), F.to_date(last), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return sorted(r["d"] for r in days.distinct().collect())


def stream_recompute(stream: DataFrame, touched_keys: Callable[[DataFrame], DataFrame],
                     keys: Sequence[str], build, sink: str, sink_key: Sequence[str],
                     checkpoint: str, stamp: Callable[[int], Column], shard: Sequence[str] = (),
                     order_by: Sequence[str] = (), available_now: bool = True,
                     day_col: str | None = None, start_col: str = "slot_start_date_time",
                     length: dt.timedelta = dt.timedelta(days=1),
                     sink_names: dict[str, str] | None = None,
                     store: Callable[[DataFrame, int], None] | None = None):
    """Drive ``build(restrict, days, batch_id)`` over the keys each micro-batch touches; the
    result, stamped ``updated_at = stamp(batch_id)``, replaces these keys' rows in ``sink``.

    ``start_col`` is the touched keys' time column and ``length`` how far rows of one key
    reach beyond it; ``sink_names`` names the touched keys' columns in the sink where they
    differ.  ``store`` (optional) adds the batch to the base tables first."""
    names = {k: (sink_names or {}).get(k, k) for k in keys}

    def each(batch: DataFrame, batch_id: int) -> None:
        if store is not None:
            store(batch, batch_id)
        touched = touched_keys(batch).select(*keys).distinct()
        days = touched_days(touched, start_col, length)
        if not days:
            return
        out = recompute_touched(touched, keys, lambda restrict: build(restrict, days, batch_id)) \
            .withColumn("updated_at", stamp(batch_id))
        scope = touched.select(*(F.col(k).alias(n) for k, n in names.items()))
        held = set(days)
        replace_scope(out, sink, sink_key, lambda rows: rows.join(scope, list(names.values()), "left_semi"),
                      stamp(batch_id), shard=shard, order_by=order_by, run_id=f"batch-{batch_id:08d}", day_col=day_col,
                      days=(lambda d: d in held) if day_col else None)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def first_per_group_stream(stream: DataFrame, group: Sequence[str], order: Sequence[str], keep: Sequence[str],
                           sink: str, sink_key: Sequence[str], checkpoint: str,
                           finish: Callable[[DataFrame, int], DataFrame], event_time: str | None = None,
                           watermark: str | None = None, order_by: Sequence[str] = (),
                           day_col: str | None = None, available_now: bool = True):
    """The least (order, keep) row per group as a stateful aggregation in update mode.

    The state store holds one row per group.  Each micro-batch emits the groups whose least
    row it changed, ``finish(rows, batch_id)`` shapes and stamps them, and they are appended
    to a replacing table whose key is the group, so nothing has to be withdrawn.  With
    ``event_time`` (a zone-free column of the group) and ``watermark`` groups older than the
    watermark leave the state; rows that come later than that are not seen (jobs that must
    see them use ``stream_recompute``)."""
    rows = stream
    if watermark:
        # watermarks are defined on instants: the zone-free time is read as UTC
        rows = rows.withColumn("_at", _instant(event_time)).withWatermark("_at", watermark)
    first = first_per_group(rows, [*group, *(["_at"] if watermark else [])], order, keep).drop("_at")

    def each(batch: DataFrame, batch_id: int) -> None:
        append(finish(batch, batch_id), sink, key=sink_key, order_by=order_by, run_id=f"batch-{batch_id:08d}", day_col=day_col)

    writer = first.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def distinct_stream(stream: DataFrame, key: Sequence[str], sink: str, checkpoint: str,
                    finish: Callable[[DataFrame, int], DataFrame], horizon: str = "1 day",
                    bloom: Sequence[str] = (), available_now: bool = True):
    """The distinct keys of a stream, kept by ``dropDuplicatesWithinWatermark``.

    The watermark runs on the time of *arrival* (the micro-batch's clock), so no row is ever
    late, whatever its event time; the state holds the keys that arrived within ``horizon``.
    A key that comes again later is emitted again and collapses in the replacing table, whose
    key it is: the state is bounded and the result exact."""
    once = stream.select(*key).withColumn("_arrived", F.current_timestamp()) \
        .withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(list(key)).drop("_arrived")

    def each(batch: DataFrame, batch_id: int) -> None:
        append(finish(batch, batch_id), sink, key=key, order_by=key, run_id=f"batch-{batch_id:08d}", bloom=bloom)

    writer = once.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _instant(column: str) -> Column:
    """A zone-free time read as UTC, by its count of microseconds (no bound passes through
    the session's zone)."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{column}`)"))


def tumbling_counts(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (),
                    watermark: str | None = None) -> DataFrame:
    """Rows per event-time tumbling window (and keys); streaming needs ``watermark``.

    Watermarks are defined on instants only, so there a wall-clock (ntz) column is read as UTC."""
    instants = bool(watermark) and df.schema[ts].dataType.typeName() == "timestamp_ntz"
    if instants:
        df = df.withColumn(ts, _instant(ts))
    if watermark:
        df = df.withWatermark(ts, watermark)
    out = df.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))

    def bound(name: str):
        c = F.expr(f"timestampadd(MICROSECOND, unix_micros(w.{name}), {_EPOCH})") if instants \
            else F.col(f"w.{name}").cast("timestamp_ntz")
        return c.alias(f"window_{name}")

    return out.select(bound("start"), bound("end"), *keys, "events")
