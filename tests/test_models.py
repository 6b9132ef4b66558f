"""Golden micro-cases for the jobs (the edge cases of the fixtures list)."""

import datetime as dt

from pyspark.sql import functions as F

from quorum.functions.keys import naive_concat_key, surrogate_key
from quorum.plans import models as M
from quorum.plans.tables import FrameSources
from quorum.sources.scan import RunWindow, in_window, in_window_whole_seconds

D = dt.datetime
T0 = D(2024, 1, 1)
ALL = RunWindow.backfill()
RUN = "2024-02-01 00:00:00"


def frame(spark, ddl, rows):
    return spark.createDataFrame(rows, ddl)


BLOCK = "slot long, slot_start_date_time timestamp_ntz, epoch long, block string, meta_network_name string"
GOSSIP = "unique_key long, updated_date_time timestamp_ntz, " + BLOCK
CANON = ("updated_date_time timestamp_ntz, slot long, slot_start_date_time timestamp_ntz, epoch long, "
         "block_root string, state_root string, meta_network_name string")


def blocks_sources(spark, event, gossip, canon):
    return FrameSources({
        "beacon_api_eth_v1_events_block": frame(spark, BLOCK, event),
        "libp2p_gossipsub_beacon_block": frame(spark, GOSSIP, gossip),
        "canonical_beacon_block": frame(spark, CANON, canon),
    })


def test_blocks_reconciliation_cases(spark):
    s1, s2, s3 = T0, D(2024, 1, 1, 0, 0, 12), D(2024, 1, 1, 0, 0, 24)
    src = blocks_sources(
        spark,
        event=[(1, s1, 0, "0xA", "m"), (1, s1, 0, "0xA", "m"), (2, s2, 0, "0xX", "m"),
               (2, s2, 0, "0xY", "m")],
        gossip=[(10, T0, 2, s2, 0, "0xX", "m"), (11, T0, 2, s2, 0, "0xZ", "m"),
                (12, T0, 3, s3, 0, "0xQ", "m"),
                (12, D(2024, 1, 2), 3, s3, 0, "0xQ", "m")],          # two versions, one row
        canon=[(T0, 1, s1, 0, "0xA", "0xs", "m"), (D(2024, 1, 2), 1, s1, 0, "0xA", "0xs", "m"),
               (T0, 2, s2, 0, "0xX", "0xs", "m")])
    out = {r.slot: r for r in M.blocks(src, ALL, RUN).collect()}
    # slot 1: only the event stream saw it -> gossip count 0, canonical root not listed
    assert out[1].total_seen_beacon_api_event_stream == 2 and out[1].total_seen_gossipsub == 0
    assert out[1].non_canonical_beacon_api_event_stream_block_root_hashes == []
    # slot 2: two roots x two sources crossed; canonical X is excluded from both sets
    assert out[2].non_canonical_beacon_api_event_stream_block_root_hashes == ["0xY"]
    assert out[2].non_canonical_gossipsub_block_root_hashes == ["0xZ"]
    assert out[2].total_seen_beacon_api_event_stream == 1 and out[2].total_seen_gossipsub == 1
    # slot 3: no canonical block -> every seen root listed; latest-version read counts once
    assert out[3].canonical_beacon_block_root_hash is None
    assert out[3].non_canonical_gossipsub_block_root_hashes == ["0xQ"]
    assert out[3].total_seen_gossipsub == 1 and out[3].total_seen_beacon_api_event_stream == 0


def test_blob_counts_mapping_and_precedence(spark):
    s = T0
    ev = frame(spark, "slot long, slot_start_date_time timestamp_ntz, epoch long, block_root string, "
                      "blob_index long, meta_network_name string",
               [(1, s, 0, "0xE", 2, "m")])
    cb = frame(spark, "unique_key long, updated_date_time timestamp_ntz, slot long, "
                      "slot_start_date_time timestamp_ntz, epoch long, block_root string, "
                      "blob_index long, meta_network_name string",
               [(1, T0, 1, s, 0, "0xC", 0, "m")])
    gb = frame(spark, "unique_key long, updated_date_time timestamp_ntz, slot long, "
                      "slot_start_date_time timestamp_ntz, epoch long, state_root string, "
                      "blob_index long, meta_network_name string",
               [(1, T0, 5, s, 1, "0xS5", 3, "m"),      # mapped through both maps (fan-out)
                (2, T0, 6, s, 1, "0xS6", 1, "m")])     # unmapped, no other source: dropped
    api = frame(spark, "slot long, slot_start_date_time timestamp_ntz, epoch long, block_root string, "
                       "state_root string, meta_network_name string",
                [(5, s, 1, "0xG5", "0xS5", "m")])
    canon = frame(spark, CANON, [(T0, 5, s, 1, "0xG5", "0xS5", "m")])
    src = FrameSources({"beacon_api_eth_v1_events_blob_sidecar": ev,
                        "canonical_beacon_blob_sidecar": cb,
                        "libp2p_gossipsub_blob_sidecar": gb,
                        "beacon_api_eth_v2_beacon_block": api,
                        "canonical_beacon_block": canon})
    out = {(r.slot, r.beacon_block_root_hash): r.blob_count
           for r in M.block_blobs(src, ALL, RUN).collect()}
    assert out == {(1, "0xC"): 1, (5, "0xG5"): 4}      # canonical wins slot 1; slot 6 dropped


ATT_DDL = ("slot long, slot_start_date_time timestamp_ntz, epoch long, committee_index string, "
           "beacon_block_root string, source_epoch long, source_root string, target_epoch long, "
           "target_root string, meta_network_name string, meta_consensus_implementation string")


def att_rows(slot, net, client, votes):
    return [(slot, T0, 0, "0", v, 0, "s", 0, "t", net, client) for v in votes]


def test_divergence_scope_quirk(spark):
    clients = ["prysm", "teku", "lodestar", "lighthouse", "nimbus"]
    rows = []
    for c in clients:
        rows += att_rows(1, "mainnet", c, ["A", "A"])       # unanimous everywhere on mainnet
    rows += att_rows(1, "holesky", "prysm", ["A", "A", "B"])  # maxcnt 2, total 3
    rows += att_rows(1, "holesky", "teku", ["A"])
    src = FrameSources({"beacon_api_eth_v1_validator_attestation_data": frame(spark, ATT_DDL, rows)})
    ref = {r.network: r for r in M.attestation_divergence(src, ALL, RUN).collect()}
    fix = {r.network: r for r in M.attestation_divergence(src, ALL, RUN, scope="network").collect()}
    # holesky prysm: top count 2 equals mainnet's prysm total 2 -> reference says unanimous
    assert ref["holesky"].prysm_all_equal == 1 and fix["holesky"].prysm_all_equal == 0
    assert ref["mainnet"].all_equal == 1 and fix["mainnet"].all_equal == 1
    # absent clients make all_equal 0
    assert ref["holesky"].lodestar_all_equal == 0 and ref["holesky"].all_equal == 0


def test_participation_nulls_duplicates_and_empty(spark):
    att = frame(spark, "slot long, slot_start_date_time timestamp_ntz, attesting_validator_index long, "
                       "meta_network_name string",
                [(1, T0, 1, "m"), (1, T0, 1, "m"), (1, T0, None, "m"), (1, T0, 2, "m")])
    com = frame(spark, "slot long, slot_start_date_time timestamp_ntz, committee_index string, "
                       "validators array<long>, meta_network_name string",
                [(1, T0, "0", [1, 2, 3], "m"), (1, T0, "0", [2, 3], "m"),   # sentries disagree
                 (1, T0, "1", [4], "m"), (1, T0, "1", [], "m")])
    src = FrameSources({"beacon_api_eth_v1_events_attestation": att,
                        "beacon_api_eth_v1_beacon_committee": com})
    r = M.network_participation(src, ALL, RUN).first()
    assert (r.attesting_validators, r.total_validators) == (2, 4)
    assert abs(r.participation_rate - 0.5) < 1e-12


def test_members_and_missing_by_nearest_class(spark):
    att = frame(spark, "slot long, slot_start_date_time timestamp_ntz, attesting_validator_index long, "
                       "meta_network_name string",
                [(10, T0, 1, "mainnet"), (10, T0, 1, "mainnet"), (10, T0, None, "mainnet"),
                 (10, T0, 2, "mainnet")])
    cls = frame(spark, "updated_date_time timestamp_ntz, slot long, slot_start_date_time timestamp_ntz, "
                       "best_guess_single string, proposer_index long, meta_network_name string",
                [(T0, 8, T0, "PRYSM", 1, "mainnet"), (T0, 12, T0, "TEKU", 1, "mainnet"),
                 (T0, 30, T0, "", 3, "mainnet")])
    com = frame(spark, "slot long, slot_start_date_time timestamp_ntz, committee_index string, "
                       "validators array<long>, meta_network_name string",
                [(10, T0, "0", [1, 2, 3], "mainnet"), (10, T0, "0", [1, 2, 3], "mainnet")])
    src = FrameSources({"beacon_api_eth_v1_events_attestation": att,
                        "beacon_block_classification": cls,
                        "beacon_api_eth_v1_beacon_committee": com})
    seen = {r.guess: r.occurrences for r in M.attesting_validators(src, ALL, RUN).collect()}
    # member 1: tie 8 vs 12 -> earlier (PRYSM); member 2: no class; NULL member -> unknown
    assert seen == {"PRYSM": 1, "unknown": 2}
    missing = {r.guess: r.occurrences for r in M.offline_attesting_validators(src, ALL, RUN).collect()}
    assert missing == {"unknown": 1}                       # member 3, class '' -> unknown


def test_first_reporter_filters_and_ties(spark):
    ddl = ("slot long, slot_start_date_time timestamp_ntz, propagation_slot_start_diff long, "
           "attesting_validator_index long, meta_client_geo_country string, "
           "meta_client_geo_continent_code string, meta_network_name string, "
           "meta_consensus_implementation string")
    att = frame(spark, ddl, [(1, T0, 50, 7, "FR", "EU", "mainnet", "teku"),
                             (1, T0, 20, 7, "JP", "AS", "mainnet", "teku"),
                             (1, T0, 20, 7, "JP", "AS", "holesky", "teku"),   # tie across networks
                             (1, T0, 5, 7, "US", "NA", "mainnet", "prysm"),   # other client
                             (1, T0, 1, None, "US", "NA", "mainnet", "teku")])  # NULL member
    src = FrameSources({"beacon_api_eth_v1_events_attestation": att})
    rows = M.attestation_nearest_client(src, ALL, RUN).collect()
    assert [(r.validator_index, r.nearest_client_country, r.network) for r in rows] == \
        [(7, "JP", "holesky")]
    rows = M.attestation_nearest_client(src, ALL, RUN, by_network=True).collect()
    assert sorted(r.network for r in rows) == ["holesky", "mainnet"]


def test_tx_rollups_null_sets_and_seconds(spark):
    bn = frame(spark, "unique_key long, updated_date_time timestamp_ntz, detecttime timestamp_ntz, "
                      "hash string, status string, region string, failurereason string, "
                      "nonce long, gas long, gasprice long, "
                      "value long, fromaddress string, datasize long, network string, type smallint",
               [(1, T0, T0, "0xh", "pending", "eu", None, 1, 2, 3, 4, "0xf", 1, "main", 2),
                (2, T0, D(2024, 1, 1, 0, 1), "0xh", "confirmed", "eu", None, 1, 2, 3, 4, "0xf", 1, "main", 2)])
    src = FrameSources({"block_native_mempool_transaction": bn})
    r = M.transaction_block_native(src, ALL, RUN).first()
    assert r.statuses == ["confirmed", "pending"] and r.failure_reasons == []
    assert r.first_detected_at == T0 and r.network == "mainnet"
    # value above 10^38 - 1 is rejected by the declared decimal(38,0), not wrapped
    big = frame(spark, "v string", [("1" + "0" * 38,)]).select(F.col("v").try_cast("decimal(38,0)").alias("v"))
    assert big.first().v is None


def test_window_edges(spark):
    df = frame(spark, "ts timestamp_ntz", [(D(2024, 1, 1, 23),), (D(2024, 1, 2),), (D(2024, 1, 3),),
                                           (D(2024, 1, 3, 0, 0, 0, 999000),), (D(2024, 1, 1, 22, 59),)])
    w = RunWindow.of("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    inclusive = df.filter(in_window(F.col("ts"), w, "1 HOUR")).count()
    whole = df.filter(in_window_whole_seconds(F.col("ts"), w)).count()
    assert inclusive == 3            # start - grace and end are both inside
    assert whole == 3                # end + 999 ms is inside the last whole second


def test_surrogate_key_has_no_concatenation_collision(spark):
    df = frame(spark, "slot long, v long", [(1, 23), (12, 3)])
    rows = df.select(surrogate_key("slot", "v").alias("k"), naive_concat_key("slot", "v").alias("n")).collect()
    assert rows[0].n == rows[1].n and rows[0].k != rows[1].k


def test_first_per_group_aggregate_equals_row_number(spark):
    from quorum.operators.ranking import first_per_group, first_per_group_ranked
    from quorum.sources.adapters import Fixture
    from tests.conftest import SMALL
    a = Fixture(spark, SMALL).attestation.filter(F.col("attesting_validator_index").isNotNull())
    args = (["slot_start_date_time", "attesting_validator_index"], ["propagation_slot_start_diff"],
            ["meta_network_name", "meta_client_geo_country", "slot"])
    x = sorted(tuple(r) for r in first_per_group(a, *args).collect())
    y = sorted(tuple(r) for r in first_per_group_ranked(a, *args).collect())
    assert x == y and len(x) > 100


def test_zero_expected_members_gives_null_rate(spark):
    att = frame(spark, "slot long, slot_start_date_time timestamp_ntz, attesting_validator_index long, "
                       "meta_network_name string", [(1, T0, 1, "m")])
    com = frame(spark, "slot long, slot_start_date_time timestamp_ntz, committee_index string, "
                       "validators array<long>, meta_network_name string", [(1, T0, "0", [], "m")])
    src = FrameSources({"beacon_api_eth_v1_events_attestation": att,
                        "beacon_api_eth_v1_beacon_committee": com})
    r = M.network_participation(src, ALL, RUN).first()
    assert (r.attesting_validators, r.total_validators, r.participation_rate) == (1, 0, None)


def test_reconciliation_of_many_roots_and_starts(spark):
    """Against the chained full outer join, regrouped: slots whose sources hold many roots,
    several starts, or are absent."""
    import random

    from quorum.operators.reconcile import crossed_sightings
    rng = random.Random(4)
    schema = "slot int, {0}_root string, {0}_start int, {0}_cnt long"
    rows = {p: [(s, f"r{i}", rng.randrange(2), rng.randrange(1, 9)) for s in range(30) if rng.random() < 0.6
                for i in range(rng.choice((1, 2, 40)))] for p in "eg"}
    rows["c"] = [(s, f"r{i}", rng.randrange(2), None) for s in range(30) if rng.random() < 0.6 for i in range(rng.choice((1, 2)))]
    frames = [spark.createDataFrame(rows[p], schema.format(p)) for p in "egc"]
    got = {(r.slot, r.slot_started_at): (r.canonical, set(r.e_roots), set(r.g_roots), r.e_cnt, r.g_cnt)
           for r in crossed_sightings(*frames, ["slot"]).collect()}
    want = {}
    for slot in {s for p in "egc" for s, *_ in rows[p]}:
        of = {p: [r[1:] for r in rows[p] if r[0] == slot] or [(None, None, None)] for p in "egc"}
        for e in of["e"]:
            for g in of["g"]:
                for c in of["c"]:
                    start = next(x[1] for x in (e, g, c) if x[0] is not None)
                    want.setdefault((slot, start), []).append((c[0], e[0], g[0], e[2] or 0, g[2] or 0))
    want = {k: (max((c for c, *_ in v if c), default=None), {e for _, e, *_ in v if e}, {g for _, _, g, *_ in v if g},
                max(e for *_, e, _ in v), max(g for *_, g in v)) for k, v in want.items()}
    assert got == want
