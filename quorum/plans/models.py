"""The twelve telemetry jobs as compositions of operators.

Every job is ``build(sources, window, run_ts, **options) -> DataFrame``: lazy, no action,
no collect.  ``window`` is the run window (``RunWindow``); the job subtracts its own grace
period where the source system does.  ``run_ts`` stamps ``updated_at``, the version of the
replacing output table (newer runs win on read).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.functions.keys import packed_hex, surrogate_key, unpacked_hex
from quorum.functions.sets import distinct_set
from quorum.functions.timefns import ntz, truncate_to_second
from quorum.operators.membership import explode_members, missing_members
from quorum.operators.nearest import nearest_join
from quorum.operators.participation import participation
from quorum.operators.ranking import first_per_group
from quorum.operators.reconcile import (crossed_sightings, other_roots, precedence_rows,
                                        source_rollup)
from quorum.operators.rollup import distinct_rows, rollup, union_all
from quorum.operators.unanimity import CLIENTS, unanimity
from quorum.operators.versioned import latest_by_key
from quorum.plans.tables import Sources
from quorum.sources.catalog import source
from quorum.sources.scan import RunWindow, day_prune, in_window, in_window_whole_seconds

ATT = "beacon_api_eth_v1_events_attestation"
COMMITTEE = "beacon_api_eth_v1_beacon_committee"
CLASSIFICATION = "beacon_block_classification"


def _latest(src: Sources, name: str) -> DataFrame:
    """Latest-version read of a replacing source (``FINAL``)."""
    s = source(name)
    return latest_by_key(src.get(name), s.key, s.version)


def _scan(src: Sources, name: str, window: RunWindow | None, grace: str | None,
          final: bool = False) -> DataFrame:
    """Windowed scan; ``final`` adds the latest-version read.  The window filter goes
    first so that it reaches the Parquet reader and the dedupe only sees the window: exact,
    because every declared key contains the slot (or a row hash), which fixes the time
    column -- versions of one key never straddle a window edge."""
    df = src.get(name)
    if window is not None:
        pruned = day_prune(df, window, grace)
        if pruned is not None:
            df = df.filter(pruned)
        df = df.filter(in_window(F.col(source(name).time_col), window, grace))
    if final:
        s = source(name)
        df = latest_by_key(df, s.key, s.version)
    return df


def _stamp(run_ts) -> Column:
    return ntz(run_ts).alias("updated_at")


# ---- M1 ---------------------------------------------------------------------------------
KEY = ["slot", "epoch", "network"]


def blocks(src: Sources, window: RunWindow, run_ts, grace: str = "1 DAY") -> DataFrame:
    """Three-source block reconciliation per (slot, epoch, network)."""
    e = source_rollup(_scan(src, "beacon_api_eth_v1_events_block", window, grace),
                      "e", "block", count=True)
    g = source_rollup(_scan(src, "libp2p_gossipsub_beacon_block", window, grace, final=True),
                      "g", "block", count=True)
    c = source_rollup(_scan(src, "canonical_beacon_block", window, grace, final=True),
                      "c", "block_root")
    out = crossed_sightings(e, g, c, KEY)
    return out.select(
        _stamp(run_ts), "slot", "slot_started_at", "epoch", "network",
        F.col("canonical").alias("canonical_beacon_block_root_hash"),
        other_roots("e_roots", "canonical")
        .alias("non_canonical_beacon_api_event_stream_block_root_hashes"),
        other_roots("g_roots", "canonical").alias("non_canonical_gossipsub_block_root_hashes"),
        F.col("e_cnt").alias("total_seen_beacon_api_event_stream"),
        F.col("g_cnt").alias("total_seen_gossipsub"))


# ---- M2 ---------------------------------------------------------------------------------
def _root_map(df: DataFrame) -> DataFrame:
    return distinct_rows(df, [F.col("slot").cast("int").alias("slot"),
                              F.col("block_root").alias("g_root"),
                              F.col("meta_network_name").alias("network"),
                              F.col("state_root").alias("state_root")])


def block_blobs(src: Sources, window: RunWindow, run_ts, grace: str = "1 DAY") -> DataFrame:
    """Blob count per block from three sources; precedence canonical > event > gossip."""
    e = source_rollup(_scan(src, "beacon_api_eth_v1_events_blob_sidecar", window, grace),
                      "e", "block_root", max_index="blob_index")
    c = source_rollup(_scan(src, "canonical_beacon_blob_sidecar", window, grace, final=True),
                      "c", "block_root", max_index="blob_index")
    root_map = union_all([
        _root_map(_scan(src, "beacon_api_eth_v2_beacon_block", window, grace)),
        _root_map(_scan(src, "canonical_beacon_block", window, grace, final=True)),
    ])
    gs = source_rollup(_scan(src, "libp2p_gossipsub_blob_sidecar", window, grace, final=True),
                       "g", "state_root", max_index="blob_index")
    gs = gs.withColumnRenamed("g_root", "state_root")
    g = gs.join(root_map, ["slot", "state_root", "network"], "left").drop("state_root")
    rows = precedence_rows([("c", c), ("e", e), ("g", g)], KEY) \
        .filter(F.col("root").isNotNull())
    out = rows.groupBy("slot", F.col("start").alias("slot_started_at"), "epoch", "network",
                       F.col("root").alias("beacon_block_root_hash")) \
              .agg(F.max("cnt").cast("bigint").alias("blob_count"))
    return out.select(_stamp(run_ts), "slot", "slot_started_at", "epoch", "network",
                      "beacon_block_root_hash", "blob_count")


# ---- M3 ---------------------------------------------------------------------------------
VOTE = ("beacon_block_root", "source_epoch", "source_root", "target_epoch", "target_root")


def attestation_divergence(src: Sources, window: RunWindow, run_ts, grace: str = "1 HOUR",
                           scope: str = "reference", clients=CLIENTS) -> DataFrame:
    """Per (slot, committee, network): is every named client unanimous on its vote?"""
    df = _scan(src, "beacon_api_eth_v1_validator_attestation_data", window, grace)
    group = ["slot_start_date_time", "slot", "epoch", "committee_index", "meta_network_name"]
    flags = unanimity(df, group, "meta_consensus_implementation", VOTE,
                      match_keys=["slot", "committee_index"], clients=clients, scope=scope)
    return flags.select(
        F.col("slot_start_date_time").alias("slot_started_at"), "slot", "epoch",
        "committee_index", F.col("meta_network_name").alias("network"),
        surrogate_key("slot_start_date_time", "slot", "committee_index", "meta_network_name")
        .alias("unique_key"),
        _stamp(run_ts), "all_equal", *[f"{c}_all_equal" for c in clients])


# ---- M4 ---------------------------------------------------------------------------------
def network_participation(src: Sources, window: RunWindow | None, run_ts,
                          grace: str = "1 HOUR", restrict=None, strategy: str | None = None) -> DataFrame:
    """Distinct members seen / members expected per (slot, network).  ``restrict``
    (optional) narrows both inputs, e.g. to the keys a stream batch touched; ``strategy``
    hints the join, see ``participation``."""
    keys = ["slot", "slot_start_date_time", "meta_network_name"]
    seen = _scan(src, ATT, window, grace)
    expected = _scan(src, COMMITTEE, window, grace)
    if restrict is not None:
        seen, expected = restrict(seen), restrict(expected)
    out = participation(seen, expected, keys, member="attesting_validator_index",
                        committee="committee_index", members="validators", strategy=strategy)
    return out.select(
        "slot", F.col("slot_start_date_time").alias("slot_started_at"),
        F.col("meta_network_name").alias("network"), "attesting_validators",
        "total_validators", "participation_rate",
        surrogate_key("slot", "meta_network_name").alias("unique_key"), _stamp(run_ts))


# ---- M5 / M6 ----------------------------------------------------------------------------
def _label_by_nearest_class(src: Sources, members: DataFrame, run_ts,
                            range_width: int) -> DataFrame:
    classes = _latest(src, CLASSIFICATION)
    labelled = nearest_join(
        members, classes,
        on=[("validator_index", "proposer_index"), ("meta_network_name", "meta_network_name")],
        left_pos="slot", right_pos="slot", values=["best_guess_single"],
        range_width=range_width, distance_col=None, left_unique=True)
    guess = F.coalesce(F.when(F.col("best_guess_single") == "", F.lit("unknown"))
                       .otherwise(F.col("best_guess_single")), F.lit("unknown"))
    counted = (labelled.withColumn("guess", guess)
               .groupBy("slot", "slot_start_date_time", "meta_network_name", "guess")
               .agg(F.count(F.lit(1)).alias("occurrences")))
    return counted.select(
        "slot", F.col("slot_start_date_time").alias("slot_started_at"),
        F.col("meta_network_name").alias("network"), "guess", "occurrences",
        surrogate_key("slot", "meta_network_name", "guess").alias("unique_key"), _stamp(run_ts))


def attesting_validators(src: Sources, window: RunWindow, run_ts, grace: str = "5 MINUTE",
                         range_width: int = 64) -> DataFrame:
    """Distinct members seen per slot, counted by the class of their nearest proposal."""
    seen = distinct_rows(_scan(src, ATT, window, grace),
                         ["slot", "slot_start_date_time", "meta_network_name",
                          F.col("attesting_validator_index").alias("validator_index")])
    return _label_by_nearest_class(src, seen, run_ts, range_width)


def offline_attesting_validators(src: Sources, window: RunWindow, run_ts,
                                 grace: str = "5 MINUTE", network: str = "mainnet",
                                 range_width: int = 64) -> DataFrame:
    """Expected members never seen in their slot, counted by nearest class."""
    keys = ["slot", "slot_start_date_time", "meta_network_name"]
    on = ["slot", "validator_index", "meta_network_name"]
    committees = _scan(src, COMMITTEE, window, grace) \
        .filter(F.col("meta_network_name") == network)
    # sentries repeat committee rows and sightings: one aggregation drops both repeats
    expected = explode_members(committees, keys, "validators", "validator_index")
    seen = (_scan(src, ATT, window, grace).filter(F.col("meta_network_name") == network)
            .select("slot", F.col("attesting_validator_index").alias("validator_index"),
                    "meta_network_name"))
    missing = missing_members(expected, seen, on)
    return _label_by_nearest_class(src, missing, run_ts, range_width)


# ---- M7 ---------------------------------------------------------------------------------
def attestation_nearest_client(src: Sources, window: RunWindow | None, run_ts,
                               grace: str = "5 MINUTE", client: str = "teku",
                               by_network: bool = False, restrict=None) -> DataFrame:
    """Per (slot start, member) the report with the least propagation delay.
    ``restrict`` (optional) narrows the reports, e.g. to the keys a stream batch touched."""
    df = _scan(src, ATT, window, grace)
    if restrict is not None:
        df = restrict(df)
    group = (*FIRST_GROUP, "meta_network_name") if by_network else FIRST_GROUP
    return nearest_client_rows(first_per_group(nearest_client_reports(df, client), group, FIRST_ORDER, FIRST_KEEP), run_ts)


FIRST_GROUP = ("slot_start_date_time", "attesting_validator_index")
FIRST_ORDER = ("propagation_slot_start_diff",)
FIRST_KEEP = ("meta_network_name", "meta_client_geo_country", "meta_client_geo_continent_code", "slot")


def nearest_client_reports(df: DataFrame, client: str = "teku") -> DataFrame:
    """The reports that M7 ranks."""
    return df.filter(F.col("attesting_validator_index").isNotNull()
                     & (F.col("meta_consensus_implementation") == client))


def nearest_client_rows(first: DataFrame, run_ts) -> DataFrame:
    """M7's columns of the first reports."""
    return first.select(
        "slot", F.col("slot_start_date_time").alias("slot_started_at"),
        F.col("meta_network_name").alias("network"),
        F.col("attesting_validator_index").alias("validator_index"),
        F.col("meta_client_geo_country").alias("nearest_client_country"),
        F.col("meta_client_geo_continent_code").alias("nearest_client_continent_code"),
        surrogate_key("slot", "attesting_validator_index", "meta_network_name").alias("unique_key"),
        _stamp(run_ts))


# ---- M8 - M12 ---------------------------------------------------------------------------
def _touched_in_full(src: Sources, name: str, window: RunWindow | None, pred) -> DataFrame:
    """Q10 ``merge=True``: every row (any time) of the hashes the window touched, so a
    rollup is never split by a window edge.  One semi join on the hash."""
    base = src.get(name).filter(pred)
    if window is None:
        return base
    touched = _scan(src, name, window, None).filter(pred).select("hash").distinct()
    return base.join(touched, "hash", "left_semi")


def transaction_sightings(src: Sources, window: RunWindow, run_ts,
                              network: str = "mainnet", merge: bool = False) -> DataFrame:
    """Sighting rollup per transaction.  The source system cuts rollups at window edges
    (a hash seen in two windows gets two partial rows, the newer replacing the older);
    ``merge=True`` recomputes touched hashes from the whole table instead."""
    pred = F.col("meta_network_name") == network
    df = (_touched_in_full(src, "mempool_transaction", window, pred) if merge
          else _scan(src, "mempool_transaction", window, None).filter(pred))
    return SIGHTINGS.finish(SIGHTINGS.partial(df), run_ts)


_TX = ("from", "to", "nonce", "gas_price", "gas", "value", "type", "size", "call_data_size")
_TX_HEX = ("hash", "from", "to")


def _unpacked(df: DataFrame) -> DataFrame:
    return df.withColumns({c: unpacked_hex(c) for c in _TX_HEX})


def _sighting_groups(df: DataFrame) -> DataFrame:
    """Per transaction the sets of its observers and continents and its first time: one
    exchange, before which every map task has combined its rows of a transaction to one, so
    neither a hot transaction nor its attributes are sent row by row."""
    rows = df.select(packed_hex("hash").alias("hash"), F.col("meta_network_name").alias("network"),
                     packed_hex("from").alias("from"), packed_hex("to").alias("to"), *_TX[2:],
                     "meta_client_name", "meta_client_geo_continent_code", "event_date_time")
    return rollup(rows, SIGHTINGS.key, [
        distinct_set("meta_client_name").alias("observers"),
        distinct_set("meta_client_geo_continent_code").alias("seen_continents"),
        F.min("event_date_time").alias("first_seen_at")])


def _sightings(groups: DataFrame, run_ts) -> DataFrame:
    return _unpacked(groups).select(
        "hash", _stamp(run_ts), "network", *_TX, F.size("observers").cast("bigint").alias("total_seen_by_sentries"),
        "seen_continents", "first_seen_at")


def transaction_block_native(src: Sources, window: RunWindow, run_ts,
                             network: str = "main", merge: bool = False) -> DataFrame:
    """Lifecycle rollup per transaction; ``merge`` as for the sighting rollup."""
    pred = F.col("network") == network
    df = (_touched_in_full(src, "block_native_mempool_transaction", window, pred) if merge
          else _scan(src, "block_native_mempool_transaction", window, None).filter(pred))
    return LIFECYCLES.finish(LIFECYCLES.partial(df), run_ts)


_LIFE = ("hash", "nonce", "gas", "gas_price", "value", "to", "from", "call_data_size", "call_data_4_bytes", "type")
# Output columns of M9: sets and minima with their source columns, in the table's order.
_LIFE_SETS = {"statuses": "status", "base_fee_per_gas": "basefeepergas", "failure_reasons": "failurereason",
              "drop_reasons": "dropreason", "rejection_reasons": "rejectionreason", "seen_regions": "region"}
_LIFE_MINIMA = {"replace": "replace", "reorg": "reorg", "blocks_pending": "blockspending",
                "max_priority_fee_per_gas": "maxpriorityfeepergas", "max_fee_per_gas": "maxfeepergas",
                "gas_used": "gasused", "first_detected_at": "detecttime", "first_time_pending_at": "timepending"}
_LIFE_ORDER = ("statuses", "replace", "reorg", "blocks_pending", "max_priority_fee_per_gas", "max_fee_per_gas",
               "base_fee_per_gas", "gas_used", "failure_reasons", "drop_reasons", "rejection_reasons", "seen_regions",
               "first_detected_at", "first_time_pending_at")


def _lifecycle_groups(df: DataFrame) -> DataFrame:
    """Per transaction its sets and minima, combined by the map tasks before the one exchange."""
    rows = df.select(packed_hex("hash").alias("hash"), "nonce", "gas", F.col("gasprice").alias("gas_price"), "value",
                     packed_hex("toaddress").alias("to"), packed_hex("fromaddress").alias("from"),
                     F.col("datasize").alias("call_data_size"), F.col("data4bytes").alias("call_data_4_bytes"),
                     "type", *_LIFE_SETS.values(), *_LIFE_MINIMA.values())
    return rollup(rows, LIFECYCLES.key, [distinct_set(c).alias(name) for name, c in _LIFE_SETS.items()]
                  + [F.min(c).alias(name) for name, c in _LIFE_MINIMA.items()])


def _lifecycles(groups: DataFrame, run_ts) -> DataFrame:
    return _unpacked(groups).select("hash", _stamp(run_ts), *_LIFE[1:], *_LIFE_ORDER, F.lit("mainnet").alias("network"))


@dataclass(frozen=True)
class Mergeable:
    """A rollup with stored partial groups (see ``operators.states``)."""
    source: str
    predicate: Callable[[], Column]
    partial: Callable[[DataFrame], DataFrame]
    finish: Callable[..., DataFrame]
    key: tuple[str, ...]
    minima: tuple[str, ...]
    on: tuple[str, ...] = ("hash",)

    def of_window(self, src: Sources, window: RunWindow) -> DataFrame:
        return self.partial(_scan(src, self.source, window, None).filter(self.predicate()))


SIGHTINGS = Mergeable("mempool_transaction", lambda: F.col("meta_network_name") == "mainnet", _sighting_groups,
                      _sightings, ("hash", "network", *_TX), ("first_seen_at",))
LIFECYCLES = Mergeable("block_native_mempool_transaction", lambda: F.col("network") == "main", _lifecycle_groups,
                       _lifecycles, _LIFE, tuple(_LIFE_MINIMA))


def transaction_mempool_dumpster(src: Sources, window: RunWindow, run_ts,
                                 chain_id: int = 1) -> DataFrame:
    df = src.get("mempool_dumpster_transaction")
    pruned = day_prune(df, window, whole_seconds=True)
    if pruned is not None:
        df = df.filter(pruned)
    df = df.filter(in_window_whole_seconds(F.col("timestamp"), window) & (F.col("chain_id") == chain_id))
    cols = ["hash", "from", "to", "value", "nonce", "gas", "gas_price", "gas_tip_cap",
            "gas_fee_cap", "data_size", "data_4bytes", "sources", "included_at_block_height",
            truncate_to_second("included_block_timestamp").alias("included_block_timestamp"),
            "inclusion_delay_ms"]
    out = distinct_rows(df, cols)
    return out.select("hash", _stamp(run_ts), *[c for c in out.columns if c != "hash"],
                      F.lit("mainnet").alias("network"))


def _canonical_tx_cols() -> list:
    return ["hash", F.col("meta_network_name").alias("network"), "slot",
            F.col("slot_start_date_time").alias("slot_started_at"), "epoch",
            F.col("epoch_start_date_time").alias("epoch_start_at"), "block_root",
            "block_version", "position", "from", "to", "nonce", "gas_price", "gas", "value",
            "type", "size", "call_data_size"]


def transaction_canonical(src: Sources, window: RunWindow, run_ts,
                          network: str = "mainnet") -> DataFrame:
    df = _scan(src, "canonical_beacon_block_execution_transaction", window, None) \
        .filter(F.col("meta_network_name") == network)
    out = distinct_rows(df, _canonical_tx_cols())
    return out.select("hash", _stamp(run_ts), *[c for c in out.columns if c != "hash"])


def hash_rows(src: Sources, window: RunWindow | None) -> DataFrame:
    """The hashes every transaction source saw in the window (own time column and own network
    predicate per source), with repeats."""
    parts = [
        _scan(src, "mempool_transaction", window, None)
        .filter(F.col("meta_network_name") == "mainnet"),
        _scan(src, "block_native_mempool_transaction", window, None)
        .filter(F.col("network") == "main"),
        _scan(src, "mempool_dumpster_transaction", window, None)
        .filter(F.col("chain_id") == 1),
        _scan(src, "canonical_beacon_block_execution_transaction", window, None)
        .filter(F.col("meta_network_name") == "mainnet"),
    ]
    return union_all([p.select("hash") for p in parts])


def packed_hashes(src: Sources, window: RunWindow | None) -> DataFrame:
    """``hash_rows`` with packed hashes, as they are shuffled and kept in states."""
    return hash_rows(src, window).select(packed_hex("hash").alias("hash"))


def transaction_hashes(src: Sources, window: RunWindow, run_ts) -> DataFrame:
    """Union of the sources' hashes, distinct (one shuffle on the packed hash)."""
    out = packed_hashes(src, window).distinct()
    return out.select(_stamp(run_ts), F.lit("mainnet").alias("network"), unpacked_hex("hash").alias("hash"))


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[..., DataFrame]
    interval: str
    grace: str | None
    key: tuple[str, ...]          # replacing key (output ORDER BY)
    shard: tuple[str, ...]        # file layout hash key
    day_col: str | None = None    # key column that fixes the day partition (if any)
    merges: Mergeable | None = None  # partial groups that runs may keep
    recomputes: str | None = None  # time column: a run yields every row of its window (and grace)


MODELS: dict[str, Model] = {m.name: m for m in [
    Model("blocks", blocks, "1 MONTH", "1 DAY", ("slot_started_at", "network"),
          ("slot_started_at", "network"), "slot_started_at", recomputes="slot_started_at"),
    Model("block_blobs", block_blobs, "1 MONTH", "1 DAY", ("beacon_block_root_hash", "network"),
          ("beacon_block_root_hash", "network"), recomputes="slot_started_at"),
    Model("attestation_divergence", attestation_divergence, "1 DAY", "1 HOUR",
          ("slot_started_at", "unique_key", "network"), ("unique_key",), "slot_started_at", recomputes="slot_started_at"),
    Model("network_participation", network_participation, "1 DAY", "1 HOUR",
          ("slot_started_at", "unique_key", "network"), ("unique_key",), "slot_started_at", recomputes="slot_started_at"),
    Model("attesting_validators", attesting_validators, "4 HOUR", "5 MINUTE",
          ("slot_started_at", "unique_key", "network"), ("unique_key",), "slot_started_at", recomputes="slot_started_at"),
    Model("offline_attesting_validators", offline_attesting_validators, "1 HOUR", "5 MINUTE",
          ("slot_started_at", "unique_key", "network"), ("unique_key",), "slot_started_at", recomputes="slot_started_at"),
    Model("attestation_nearest_client", attestation_nearest_client, "1 HOUR", "5 MINUTE",
          ("slot_started_at", "unique_key", "network"), ("unique_key",), "slot_started_at", recomputes="slot_started_at"),
    Model("transaction_sightings", transaction_sightings, "1 DAY", None,
          ("hash", "network"), ("hash",), merges=SIGHTINGS),
    Model("transaction_block_native", transaction_block_native, "1 DAY", None,
          ("hash", "network"), ("hash",), merges=LIFECYCLES),
    Model("transaction_mempool_dumpster", transaction_mempool_dumpster, "1 DAY", None,
          ("hash", "network"), ("hash",)),
    Model("transaction_canonical", transaction_canonical, "1 DAY", None,
          ("hash", "network"), ("hash",)),
    Model("transaction_hashes", transaction_hashes, "1 DAY", None, ("hash", "network"),
          ("hash",)),
]}
