"""Registered queries: every job and operator run over whole driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match the
DuckDB oracle of the same name (``quorum.oracle.sql``).  Presentation only differs from
the library outputs in one way: array columns are rendered as text (sorted distinct
elements joined by ',' for sets, elements in order for lists), so that both engines'
results hash alike.

Jobs run with the *backfill* window (a first run over the whole history).  The queries
about windows themselves (``window_scan``, ``run_window``, ``compact_replacing``,
``incremental_replay``) use explicit windows: there the window is the feature.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from quorum.functions.keys import naive_concat_key, surrogate_key, unpacked_hex
from quorum.functions.sets import set_string
from quorum.functions.timefns import format_ts, ntz, parse_ts_or_null
from quorum.operators.membership import explode_members
from quorum.operators.nearest import nearest_join
from quorum.operators.partial import merge_partial_sums
from quorum.operators.reconcile import other_roots, outer_chain as outer_chain_op
from quorum.operators.states import append_states, compact_states
from quorum.operators.unanimity import top_variant as top_variant_op
from quorum.operators.versioned import append, compact, latest_by_key as latest_op, read_current
from quorum.plans import models as M
from quorum.plans.runner import merged_run, replay, run_model
from quorum.plans.runwindow import commit_rows, resolve_windows
from quorum.plans.tables import BucketedSources, write_bucketed
from quorum.session import scratch_path
from quorum.sources.adapters import SLOTS_PER_EPOCH, Fixture, event_base, slot_start
from quorum.sources.catalog import source
from quorum.sources.scan import RunWindow, in_window
from quorum.streaming.incremental import distinct_stream, first_per_group_stream, stream_recompute, tumbling_counts

RUN_TS = "2024-02-01 00:00:00"
BACKFILL = RunWindow.backfill()

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


def _render_sets(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[set_string(c).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


# ---- jobs ---------------------------------------------------------------------------------
def participation_rate(spark, sf_dir):
    return M.network_participation(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def divergence(spark, sf_dir):
    return M.attestation_divergence(_fx(spark, sf_dir), BACKFILL, RUN_TS, scope="reference")


def divergence_by_network(spark, sf_dir):
    return M.attestation_divergence(_fx(spark, sf_dir), BACKFILL, RUN_TS, scope="network")


def members_by_nearest_class(spark, sf_dir):
    return M.attesting_validators(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def missing_members_by_class(spark, sf_dir):
    return M.offline_attesting_validators(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def first_reporter(spark, sf_dir):
    return M.attestation_nearest_client(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def tx_sightings(spark, sf_dir):
    return _render_sets(M.transaction_sightings(_fx(spark, sf_dir), BACKFILL, RUN_TS),
                        "seen_continents")


def tx_lifecycle(spark, sf_dir):
    return _render_sets(M.transaction_block_native(_fx(spark, sf_dir), BACKFILL, RUN_TS),
                        "statuses", "base_fee_per_gas", "failure_reasons", "drop_reasons",
                        "rejection_reasons", "seen_regions")


def tx_distinct_external(spark, sf_dir):
    df = M.transaction_mempool_dumpster(_fx(spark, sf_dir), BACKFILL, RUN_TS)
    return df.withColumn("sources", F.array_join("sources", ","))


def tx_distinct_canonical(spark, sf_dir):
    return M.transaction_canonical(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def tx_hash_universe(spark, sf_dir):
    return M.transaction_hashes(_fx(spark, sf_dir), BACKFILL, RUN_TS)


def reconcile_blocks(spark, sf_dir):
    return _render_sets(M.blocks(_fx(spark, sf_dir), BACKFILL, RUN_TS),
                        "non_canonical_beacon_api_event_stream_block_root_hashes",
                        "non_canonical_gossipsub_block_root_hashes")


def reconcile_blob_counts(spark, sf_dir):
    return M.block_blobs(_fx(spark, sf_dir), BACKFILL, RUN_TS)


# ---- operators ----------------------------------------------------------------------------
def _members(fx: Fixture) -> DataFrame:
    return fx.attestation.select("slot", "slot_start_date_time", "meta_network_name",
                                 F.col("attesting_validator_index").alias("validator_index")
                                 ).distinct()


def _nearest(spark, sf_dir, range_width):
    fx = _fx(spark, sf_dir)
    classes = latest_op(fx.classification, ("slot", "proposer_index", "meta_network_name"),
                        ("updated_date_time",))
    return nearest_join(_members(fx), classes,
                        on=[("validator_index", "proposer_index"), "meta_network_name"],
                        left_pos="slot", right_pos="slot", values=["best_guess_single"],
                        range_width=range_width, distance_col="distance", left_unique=True)


def nearest_join_q(spark, sf_dir):
    return _nearest(spark, sf_dir, 64)


def nearest_join_ordered(spark, sf_dir):
    """Same contract with one slot per range: every match goes through the range summary."""
    return _nearest(spark, sf_dir, 1)


def latest_by_key(spark, sf_dir):
    ev = _fx(spark, sf_dir).table("events")
    return latest_op(ev, ["user_id", "event_type"], ["ts", "event_id"])


def compact_replacing(spark, sf_dir):
    """M4 appended by two runs with overlapping windows; the replacing read keeps, per key,
    the row of the newer run."""
    fx = _fx(spark, sf_dir)
    path = scratch_path(spark, "compact_replacing")
    model = M.MODELS["network_participation"]
    runs = [(RunWindow.of("2024-01-01 00:00:00", "2024-01-16 00:00:00"), "2024-02-01 00:00:00"),
            (RunWindow.of("2024-01-15 00:00:00", "2024-02-01 00:00:00"), "2024-02-02 00:00:00")]
    for window, run_ts in runs:
        append(model.build(fx, window, run_ts), path, key=model.shard, order_by=model.key,
               run_id=run_ts.replace(" ", "T").replace(":", ""), day_col=model.day_col)
    return read_current(spark, path, key=model.key, version=("updated_at",))


def window_scan(spark, sf_dir):
    ev = _fx(spark, sf_dir).table("events")
    window = RunWindow.of("2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return ev.filter(in_window(F.col("ts"), window, "1 DAY")) \
             .select("event_id", "ts", "user_id", "event_type")


def _run_meta(spark, sf_dir):
    ev = _fx(spark, sf_dir).table("events")
    model = F.concat(F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"))
    models = ev.select(model.alias("model"))
    meta = ev.filter(F.col("event_type") != "signup").select(
        model.alias("model"), F.col("ts").alias("updated_date_time"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("last_run_date_time"))
    return models, meta


RUN_NOW = "2024-01-31 00:00:00"


def run_window(spark, sf_dir):
    """Read windows of every model, reproducing the 1-hour read cap (three cases: never
    ran, capped by last + 1 hour, capped by now)."""
    models, meta = _run_meta(spark, sf_dir)
    return resolve_windows(models, meta, RUN_NOW, "1 MONTH", read_cap="1 HOUR")


def run_commit(spark, sf_dir):
    models, meta = _run_meta(spark, sf_dir)
    return commit_rows(resolve_windows(models, meta, RUN_NOW, "1 MONTH"), RUN_NOW)


VOTE_GROUP = ["slot_start_date_time", "slot", "epoch", "committee_index", "meta_network_name"]


def top_variant(spark, sf_dir):
    return top_variant_op(_fx(spark, sf_dir).attestation_data, VOTE_GROUP,
                          "meta_consensus_implementation", M.VOTE, ["slot", "committee_index"])


def explode_members_q(spark, sf_dir):
    c = _fx(spark, sf_dir).committee
    return explode_members(c, ["slot", "slot_start_date_time", "meta_network_name",
                               "committee_index", "meta_client_name"], "validators")


def other_roots_q(spark, sf_dir):
    """Event-stream roots per slot other than the canonical one (latest version)."""
    fx = _fx(spark, sf_dir)
    keys = ["slot", "epoch", "meta_network_name"]
    seen = fx.event_block.groupBy(*keys).agg(F.collect_set("block").alias("roots"))
    canon = latest_op(fx.canonical_block, ("slot", "block_root", "meta_network_name"),
                      ("updated_date_time",)).groupBy(*keys).agg(F.max("block_root").alias("canonical"))
    out = seen.join(canon, keys, "left")
    return out.select(*keys, "canonical", set_string(other_roots("roots", "canonical")).alias("other_roots"))


def source_checks(spark, sf_dir):
    """Format rules of the transaction sources (hex widths, 128-bit range), counted."""
    from quorum.sources.checks import violations
    fx = _fx(spark, sf_dir)
    parts = [violations(fx.get(n), n).withColumn("source", F.lit(n)) for n in
             ("mempool_transaction", "block_native_mempool_transaction",
              "mempool_dumpster_transaction")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _merged(spark, sf_dir, name, *sets):
    """The run of 1997 over stored partial groups: earlier and later windows have left theirs
    (and were compacted), the run adds its own and finishes every hash it touched over all of
    its partials.  Only the run's window of the source is read."""
    fx = _fx(spark, sf_dir)
    path = scratch_path(spark, f"{name}-states")
    kept = M.MODELS[name].merges
    spans = [("1970-01-01 00:00:00", "1996-12-31 23:59:59.999999"), ("1997-12-31 23:59:59.000001", "9999-12-30 00:00:00")]
    for i, (start, end) in enumerate(spans):
        append_states(kept.of_window(fx, RunWindow.of(start, end)), path, kept.on, f"run-{i}", kept.key)
    compact_states(spark, path, kept.key, kept.minima, kept.on)
    window = RunWindow.of("1997-01-01 00:00:00", "1997-12-31 23:59:59")
    return _render_sets(merged_run(spark, name, fx, window, RUN_TS, path, "run-2"), *sets)


def tx_sightings_merged(spark, sf_dir):
    """M8 for the run window of 1997, not cut at the window edges."""
    return _merged(spark, sf_dir, "transaction_sightings", "seen_continents")


def tx_lifecycle_merged(spark, sf_dir):
    """M9 for the run window of 1997: whole lifecycles of touched hashes."""
    return _merged(spark, sf_dir, "transaction_block_native", "statuses", "base_fee_per_gas",
                   "failure_reasons", "drop_reasons", "rejection_reasons", "seen_regions")


def outer_chain_q(spark, sf_dir):
    """Per (slot, epoch, network): sightings per source, chained by full outer joins on
    the coalesced key (inputs unique per key, so no row is paired twice)."""
    fx = _fx(spark, sf_dir)
    keys = ["slot", "epoch", "network"]

    def per_key(df, alias, agg):
        return df.groupBy("slot", "epoch", F.col("meta_network_name").alias("network")).agg(agg.alias(alias))

    e = per_key(fx.event_block, "event_stream_seen", F.count(F.lit(1)))
    g = per_key(latest_op(fx.gossip_block, ("unique_key",), ("updated_date_time",)),
                "gossip_seen", F.count(F.lit(1)))
    c = per_key(latest_op(fx.canonical_block, ("slot", "block_root", "meta_network_name"),
                          ("updated_date_time",)), "canonical_roots", F.countDistinct("block_root"))
    return outer_chain_op([e, g, c], keys)


def merge_partial_sums_q(spark, sf_dir):
    return merge_partial_sums(_fx(spark, sf_dir).slot_partials,
                              ["slot", "slot_start_date_time", "meta_client_name", "meta_network_name"],
                              ["blocks", "attestations"])


def surrogate_key_q(spark, sf_dir):
    a = _fx(spark, sf_dir).attestation
    m = a.select("slot", F.col("attesting_validator_index").alias("validator_index"),
                 F.col("meta_network_name").alias("network")).distinct()
    return m.select("slot", "validator_index", "network",
                    surrogate_key("slot", "validator_index", "network").alias("unique_key"),
                    naive_concat_key("slot", "validator_index", "network").alias("naive_key"))


def slot_tumbling(spark, sf_dir):
    base = _fx(spark, sf_dir).base
    return tumbling_counts(base, "ts", "6 hours", ["meta_network_name"])


def incremental_replay(spark, sf_dir):
    """M4 run incrementally at five successive wall-clock times (7-day interval), each run
    resolving its window from the metadata the previous one committed; the replacing read
    of the output equals one run over everything."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, "incremental_replay")
    nows = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00",
            "2024-01-29 00:00:00", "2024-02-05 00:00:00"]
    out = replay(spark, "network_participation", fx, root, nows, interval="7 DAY")
    return out.drop("updated_at")


def catch_up_replay(spark, sf_dir):
    """M4 after a pause: one run, then a scheduler that retries at one and the same wall
    clock until everything is committed (four catch-up windows and one call that finds
    nothing left).  Equals one run over everything."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, "catch_up_replay")
    nows = ["2024-01-08 00:00:00"] + ["2024-02-05 00:00:00"] * 5
    return replay(spark, "network_participation", fx, root, nows, interval="7 DAY").drop("updated_at")


def compacted_read(spark, sf_dir):
    """M4 by overlapping runs with a compaction between them and a run after it: the read
    sees the base and the newer run as one table."""
    fx = _fx(spark, sf_dir)
    path = scratch_path(spark, "compacted_read")
    model = M.MODELS["network_participation"]
    days = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for i, (start, end) in enumerate(zip(days, days[1:])):
        append(model.build(fx, RunWindow.of(f"{start} 00:00:00", f"{end} 00:00:00"), f"2024-02-0{i + 1} 00:00:00", grace="1 DAY"),
               path, key=model.shard, order_by=model.key, run_id=f"run-{i}", day_col=model.day_col)
        if i == 1:
            compact(spark, path, model.key, order_by=model.key)
    return read_current(spark, path, key=model.key, version=("updated_at",)).drop("updated_at")


def bucketed_participation(spark, sf_dir):
    """M4 over sources that are stored bucketed by (slot, start, network): both aggregates and
    the join read the buckets as they lie, without an exchange."""
    fx = _fx(spark, sf_dir)
    tables = {}
    for name in (M.ATT, M.COMMITTEE):
        path = scratch_path(spark, f"bucketed-{name}")
        tables[name] = write_bucketed(fx.get(name), name, "b_" + os.path.basename(path).replace("-", "_"), path,
                                      ["slot", "slot_start_date_time", "meta_network_name"],
                                      int(spark.conf.get("spark.sql.shuffle.partitions")))
    return M.network_participation(BucketedSources(spark, tables), BACKFILL, RUN_TS, strategy="merge")


def sorted_append(spark, sf_dir):
    """The events written by ``append`` and read back file by file: per stored file, rows and
    rows out of the storage order (none)."""
    path = scratch_path(spark, "sorted_append")
    events = _fx(spark, sf_dir).table("events")
    append(events, path, key=["user_id"], order_by=["ts", "event_id"], run_id="run-0", day_col="ts")
    stored = spark.read.parquet(path).select(
        "day", "ts", "event_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    w = Window.partitionBy("file").orderBy("block", "place")
    before = F.lag(F.struct("ts", "event_id")).over(w)
    checked = stored.withColumn("descends", F.coalesce(before > F.struct("ts", "event_id"), F.lit(False)))
    return checked.groupBy("day").agg(F.count("*").alias("events"), F.count_if("descends").alias("descents"))


def display_times(spark, sf_dir):
    """Event times as display text and back: whole seconds, without a time zone."""
    ev = _fx(spark, sf_dir).table("events")
    text = format_ts("ts")
    return ev.select("event_id", text.alias("shown"), parse_ts_or_null(text).alias("parsed"),
                     parse_ts_or_null(F.concat(F.col("event_type"), F.lit(" o'clock"))).alias("unparsable"))


def _batch_files(spark: SparkSession) -> int:
    """Files that make a part of a streamed folder: one for each shuffle partition, so that a
    task's share of a part does not grow with the table."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _deliver(df: DataFrame, path: str, parts: int) -> None:
    """Add rows to a streamed folder in equal parts, dealt by a hash of whole rows: whatever
    order the files come in, every micro-batch but the first has late rows."""
    df.repartition(parts * _batch_files(df.sparkSession), F.xxhash64(*df.columns)).write.mode("append").parquet(path)


def _streamed(spark: SparkSession, schema: StructType, path: str, parts: int = 1) -> DataFrame:
    """A streamed folder, so many parts in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", parts * _batch_files(spark)).parquet(path)


def _half(df: DataFrame, half: int) -> DataFrame:
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == half)


def _stamp(batch_id: int) -> Column:
    return ntz(RUN_TS) + F.make_dt_interval(secs=F.lit(batch_id))


def _stream_model(spark, sf_dir, model_name, keys, build_restricted, label, parts=4):
    """Drive a job by a Structured Streaming file source of the events.  The base table
    starts empty and grows by each batch; the batch's touched keys are recomputed from it and
    replace their rows in a replacing table, whose current rows are returned."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, label)
    base, sink = os.path.join(root, "base"), os.path.join(root, "out")
    arriving = os.path.join(root, "arriving")
    _deliver(fx.table("events"), arriving, parts)
    stream = _streamed(spark, fx.table("events").schema, arriving)
    stored = StructType([*stream.schema.fields, StructField("day", DateType())])
    model = M.MODELS[model_name]

    def store(batch, batch_id):
        batch.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day") \
            .parquet(os.path.join(base, f"batch={batch_id}"))

    def touched(batch):
        # a late event also changes the expected members of its epoch's other slots
        epochs = event_base(batch).select("epoch", "meta_network_name").distinct()
        slots = epochs.withColumn("slot", F.explode(F.sequence(F.col("epoch") * SLOTS_PER_EPOCH,
                                                               (F.col("epoch") + 1) * SLOTS_PER_EPOCH - 1)))
        return slots.withColumn("slot_start_date_time", slot_start("slot")).select(*keys)

    def build(restrict, days, batch_id):
        so_far = spark.read.schema(stored).parquet(base).filter(F.col("day").isin(days)).select(*stream.columns)
        return build_restricted(Fixture(spark, fx.sf_dir, {"events": so_far}), restrict)

    q = stream_recompute(stream, touched, keys, build, sink, model.key, os.path.join(root, "checkpoint"), _stamp,
                         shard=model.shard, order_by=model.key, day_col=model.day_col, store=store,
                         sink_names={"slot_start_date_time": "slot_started_at", "meta_network_name": "network"})
    q.awaitTermination()
    return read_current(spark, sink, key=model.key, version=("updated_at",)).drop("updated_at")


def stream_participation(spark, sf_dir):
    """M4 driven by Structured Streaming; touched keys = (slot, slot start, network)."""
    return _stream_model(
        spark, sf_dir, "network_participation",
        ["slot", "slot_start_date_time", "meta_network_name"],
        lambda fx, r: M.network_participation(fx, None, RUN_TS, restrict=r),
        "stream_participation")


def stream_first_reporter(spark, sf_dir):
    """M7 driven by Structured Streaming; touched keys = slot starts (the rank partition).
    A late report of another network displaces a row with another replacing key, which is
    withdrawn."""
    return _stream_model(
        spark, sf_dir, "attestation_nearest_client", ["slot_start_date_time"],
        lambda fx, r: M.attestation_nearest_client(fx, None, RUN_TS, restrict=r),
        "stream_first_reporter")


def late_first_reporter(spark, sf_dir):
    """M7 by two incremental runs over one window: the first sees three of four reports, the
    second all.  Rows of the first whose replacing key no longer occurs are withdrawn."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, "late_first_reporter")
    events = fx.table("events")
    early = Fixture(spark, sf_dir, {"events": events.filter(F.xxhash64(*events.columns) % 4 != 0)})
    model = M.MODELS["attestation_nearest_client"]
    path, meta = os.path.join(root, model.name), os.path.join(root, "model_metadata")
    run_model(spark, model, early, path, meta, "2024-02-05 00:00:00", interval="60 DAY")
    run_model(spark, model, fx, path, meta, "2024-02-05 00:10:00", interval="60 DAY", grace="60 DAY")
    return read_current(spark, path, key=model.key, version=("updated_at",)).drop("updated_at")


def stream_first_reporter_state(spark, sf_dir):
    """M7 as a stateful stream: the least report per (slot start, member) in Spark's state
    store, update mode.  The stream ends after half of the rows and goes on from its
    checkpoint with the other half."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, "stream_first_reporter_state")
    arriving, sink = os.path.join(root, "arriving"), os.path.join(root, "out")
    events, key = fx.table("events"), ("slot_started_at", "validator_index")

    def finish(rows, batch_id):
        return M.nearest_client_rows(rows, RUN_TS).withColumn("updated_at", _stamp(batch_id))

    for half in (0, 1):
        _deliver(_half(events, half), arriving, 2)
        stream = Fixture(spark, sf_dir, {"events": _streamed(spark, events.schema, arriving)}).attestation
        first_per_group_stream(M.nearest_client_reports(stream), M.FIRST_GROUP, M.FIRST_ORDER, M.FIRST_KEEP, sink, key,
                               os.path.join(root, "checkpoint"), finish, event_time="slot_start_date_time",
                               watermark="60 days", order_by=key, day_col="slot_started_at").awaitTermination()
    return read_current(spark, sink, key=key, version=("updated_at",)).drop("updated_at")


class _StreamSources:
    """Sources as streams over folders of arriving files."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, StructType]):
        self.spark, self.root, self.schemas = spark, root, schemas

    def get(self, name: str) -> DataFrame:
        return _streamed(self.spark, self.schemas[name], os.path.join(self.root, name), parts=2)


def stream_hash_universe(spark, sf_dir):
    """M12 as a stateful stream over its four sources: hashes of the state's horizon are known,
    the replacing table drops the others' repeats.  The stream ends after half of each
    source's rows and goes on from its checkpoint with the other half."""
    fx = _fx(spark, sf_dir)
    root = scratch_path(spark, "stream_hash_universe")
    sink = os.path.join(root, "out")
    columns = {"mempool_transaction": "meta_network_name", "block_native_mempool_transaction": "network",
               "mempool_dumpster_transaction": "chain_id", "canonical_beacon_block_execution_transaction": "meta_network_name"}
    rows = {name: fx.get(name).select("hash", c, source(name).time_col) for name, c in columns.items()}
    streams = _StreamSources(spark, root, {name: df.schema for name, df in rows.items()})

    def finish(batch, batch_id):
        return batch.select(_stamp(batch_id).alias("updated_at"), F.lit("mainnet").alias("network"),
                            unpacked_hex("hash").alias("hash"))

    for half in (0, 1):
        for name, df in rows.items():
            # as they lie: the sources are dealt already, and no step here asks for late rows
            _half(df, half).write.mode("append").option("compression", "zstd").parquet(os.path.join(root, name))
        distinct_stream(M.packed_hashes(streams, None), ["hash"], sink, os.path.join(root, "checkpoint"), finish,
                        bloom=["hash"]).awaitTermination()
    return read_current(spark, sink, key=["hash"], version=("updated_at",)).withColumn("updated_at", ntz(RUN_TS))


QUERIES: dict[str, Query] = {
    "participation_rate": participation_rate,
    "divergence": divergence,
    "divergence_by_network": divergence_by_network,
    "members_by_nearest_class": members_by_nearest_class,
    "missing_members_by_class": missing_members_by_class,
    "nearest_join": nearest_join_q,
    "nearest_join_ordered": nearest_join_ordered,
    "first_reporter": first_reporter,
    "tx_sightings": tx_sightings,
    "tx_lifecycle": tx_lifecycle,
    "tx_distinct_external": tx_distinct_external,
    "tx_distinct_canonical": tx_distinct_canonical,
    "tx_hash_universe": tx_hash_universe,
    "reconcile_blocks": reconcile_blocks,
    "reconcile_blob_counts": reconcile_blob_counts,
    "latest_by_key": latest_by_key,
    "compact_replacing": compact_replacing,
    "window_scan": window_scan,
    "run_window": run_window,
    "run_commit": run_commit,
    "top_variant": top_variant,
    "explode_members": explode_members_q,
    "other_roots": other_roots_q,
    "outer_chain": outer_chain_q,
    "source_checks": source_checks,
    "tx_sightings_merged": tx_sightings_merged,
    "tx_lifecycle_merged": tx_lifecycle_merged,
    "merge_partial_sums": merge_partial_sums_q,
    "surrogate_key": surrogate_key_q,
    "slot_tumbling": slot_tumbling,
    "incremental_replay": incremental_replay,
    "catch_up_replay": catch_up_replay,
    "compacted_read": compacted_read, "bucketed_participation": bucketed_participation,
    "sorted_append": sorted_append,
    "display_times": display_times,
    "stream_participation": stream_participation,
    "stream_first_reporter": stream_first_reporter,
    "stream_first_reporter_state": stream_first_reporter_state,
    "stream_hash_universe": stream_hash_universe,
    "late_first_reporter": late_first_reporter,
}
