"""Concurrent incremental runs from Parquet sources, Q10 merge, bucketed compaction."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quorum.operators.versioned import compact_bucketed, current_rows, read_current
from quorum.plans import models as M
from quorum.plans.runner import run_models
from quorum.plans.tables import FrameSources, ParquetSources
from quorum.session import scratch_path
from quorum.sources.adapters import Fixture
from quorum.sources.scan import RunWindow
from tests.conftest import SMALL

D = dt.datetime


def rows(df):
    return sorted(tuple(r) for r in df.drop("updated_at").collect())


def test_parallel_runs_from_parquet_sources(spark):
    fx = Fixture(spark, SMALL)
    src_root = scratch_path(spark, "t-sources")
    needed = ["beacon_api_eth_v1_events_attestation", "beacon_api_eth_v1_beacon_committee",
              "beacon_api_eth_v1_validator_attestation_data"]
    for name in needed:
        fx.get(name).write.parquet(os.path.join(src_root, name))
    src = ParquetSources(spark, src_root)
    out = scratch_path(spark, "t-out")
    names = ["network_participation", "attestation_nearest_client", "attestation_divergence"]
    now1, now2 = D(2024, 1, 30, 12), D(2024, 1, 30, 18)
    for now in (now1, now2):
        res = run_models(spark, names, src, out, now.strftime("%Y-%m-%d %H:%M:%S"), threads=3)
        assert not any(isinstance(v, Exception) for v in res.values()), res
    for name in names:
        m = M.MODELS[name]
        step = _delta(m.interval)
        # run 1 never ran: [now1 - interval, now1]; run 2: [now1, min(now1 + interval, now2)]
        want = m.build(fx, RunWindow(now1 - step, min(now1 + step, now2)), "x")
        got = read_current(spark, os.path.join(out, name), m.key)
        assert rows(got) == rows(want), name
        assert got.count() > 0, name
    meta = spark.read.option("recursiveFileLookup", "true").parquet(os.path.join(out, "model_metadata"))
    assert meta.count() == 6


def _delta(interval):
    n, unit = interval.split()
    return {"HOUR": dt.timedelta(hours=int(n)), "DAY": dt.timedelta(days=int(n))}[unit.upper()]


def test_merge_recomputes_touched_hashes(spark):
    ddl = ("event_date_time timestamp_ntz, hash string, meta_client_name string, "
           "meta_client_geo_continent_code string, meta_network_name string")
    df = spark.createDataFrame([(D(2024, 1, 1, 10), "h", "s1", "EU", "mainnet"),
                                (D(2024, 1, 2, 10), "h", "s2", "AS", "mainnet"),
                                (D(2024, 1, 1, 11), "k", "s1", "EU", "mainnet")], ddl)
    src = FrameSources({"mempool_transaction": df})
    w2 = RunWindow.of("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    cut = {r.hash: r for r in M.transaction_sightings(src, w2, "2024-01-03 00:00:00").collect()}
    merged = {r.hash: r for r in M.transaction_sightings(src, w2, "2024-01-03 00:00:00",
                                                             merge=True).collect()}
    assert set(cut) == set(merged) == {"h"}                  # k was not touched by window 2
    assert (cut["h"].total_seen_by_sentries, cut["h"].first_seen_at) == (1, D(2024, 1, 2, 10))
    assert (merged["h"].total_seen_by_sentries, merged["h"].first_seen_at) == (2, D(2024, 1, 1, 10))
    assert merged["h"].seen_continents == ["AS", "EU"]


def test_bucketed_compaction_reads_without_shuffle(spark):
    path = scratch_path(spark, "t-bucket-src")
    t1, t2 = D(2024, 1, 1), D(2024, 1, 2)
    df = spark.createDataFrame([(i % 50, i, t1 if i < 100 else t2) for i in range(200)],
                               "k long, x long, updated_at timestamp_ntz")
    df.write.parquet(path)
    compact_bucketed(spark, path, "t_bucketed", ["k"], buckets=4, order_by=["k"])
    cur = current_rows(spark.table("t_bucketed"), ["k"])
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    assert cur.count() == 50
    assert cur.filter(F.col("updated_at") == t2).count() == 50


def test_day_partitioned_sources_are_pruned(spark):
    from quorum.plans.tables import write_source
    fx = Fixture(spark, SMALL)
    root = scratch_path(spark, "t-day-sources")
    for name in ("beacon_api_eth_v1_events_attestation", "beacon_api_eth_v1_beacon_committee"):
        write_source(fx.get(name), root, name)
    src = ParquetSources(spark, root)
    assert "day" in src.get("beacon_api_eth_v1_events_attestation").columns
    w = RunWindow.of("2024-01-10 00:00:00", "2024-01-12 00:00:00")
    got = M.network_participation(src, w, "2024-02-01 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan, plan
    assert rows(got) == rows(M.network_participation(fx, w, "2024-02-01 00:00:00"))


def test_cli_runs_and_resumes(spark, capsys):
    from quorum.cli import main
    from quorum.plans.tables import write_source
    fx = Fixture(spark, SMALL)
    root = scratch_path(spark, "t-cli")
    for name in ("beacon_api_eth_v1_events_attestation", "beacon_api_eth_v1_beacon_committee"):
        write_source(fx.get(name), os.path.join(root, "sources"), name)
    args = ["run", "--sources", os.path.join(root, "sources"), "--out", os.path.join(root, "out"),
            "--models", "network_participation"]
    assert main(args + ["--now", "2024-01-30 12:00:00"]) == 0
    assert main(args + ["--now", "2024-01-30 18:00:00"]) == 0
    out = capsys.readouterr().out
    assert "read [2024-01-29 12:00:00, 2024-01-30 12:00:00]" in out
    assert "read [2024-01-30 12:00:00, 2024-01-30 18:00:00]" in out
