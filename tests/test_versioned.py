"""Latest-version reads, the append sink, compaction."""

import datetime as dt
import re

from quorum.operators.versioned import append, compact, latest_by_key, read_current
from quorum.session import scratch_path


def test_latest_by_key_picks_greatest_version(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, "old"), (1, "a", 3, "new"), (1, "a", 2, "mid"), (2, "b", 5, "only"),
         (None, "a", 1, "null-key")], "k long, g string, v long, payload string")
    got = {(r.k, r.g): r.payload for r in latest_by_key(df, ["k", "g"], ["v"]).collect()}
    assert got == {(1, "a"): "new", (2, "b"): "only", (None, "a"): "null-key"}


def test_ties_are_deterministic(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "z"), (1, 1, "y")], "k long, v long, p string")
    assert latest_by_key(df, ["k"], ["v"]).first().p == "z"


def test_map_columns_are_carried(spark):
    df = spark.createDataFrame([(1, 1, {"a": "1"}), (1, 2, {"a": "2"})],
                               "k long, v long, m map<string,string>")
    assert latest_by_key(df, ["k"], ["v"]).first().m == {"a": "2"}


def test_append_read_current_and_compact(spark):
    path = scratch_path(spark, "t-append")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    run1 = spark.createDataFrame([(1, 10, t1), (2, 20, t1)], "k long, x long, updated_at timestamp_ntz")
    run2 = spark.createDataFrame([(2, 21, t2), (3, 30, t2)], "k long, x long, updated_at timestamp_ntz")
    append(run1, path, key=["k"], order_by=["k"], run_id="r1")
    append(run2, path, key=["k"], order_by=["k"], run_id="r2")
    raw = spark.read.parquet(path)
    assert raw.count() == 4                      # both versions stored
    cur = {r.k: r.x for r in read_current(spark, path, ["k"]).collect()}
    assert cur == {1: 10, 2: 21, 3: 30}
    base = compact(spark, path, ["k"])
    assert spark.read.parquet(f"{path}/run_id={base}").count() == 3
    assert {r.k: r.x for r in read_current(spark, path, ["k"]).collect()} == cur
    # a newer run is read beside the base; a second compaction folds both
    t3 = dt.datetime(2024, 1, 3)
    append(spark.createDataFrame([(1, 11, t3)], "k long, x long, updated_at timestamp_ntz"), path, key=["k"], run_id="r3")
    cur[1] = 11
    assert {r.k: r.x for r in read_current(spark, path, ["k"]).collect()} == cur
    assert compact(spark, path, ["k"]) != base
    assert {r.k: r.x for r in read_current(spark, path, ["k"]).collect()} == cur
    # a base without a marker (a compaction that died) is not read
    append(spark.createDataFrame([(9, 9, t3)], "k long, x long, updated_at timestamp_ntz"), path, key=["k"], run_id="base-0")
    assert {r.k: r.x for r in read_current(spark, path, ["k"]).collect()} == cur


def test_of_equal_versions_the_newer_run_wins(spark):
    path = scratch_path(spark, "t-equal")
    t = dt.datetime(2024, 1, 1)
    for run, x in (("run-1", 50), ("run-2", 7)):
        append(spark.createDataFrame([(1, x, t)], "k long, x long, updated_at timestamp_ntz"), path, key=["k"], run_id=run)
    assert read_current(spark, path, ["k"]).first().x == 7
    compact(spark, path, ["k"])
    append(spark.createDataFrame([(1, 3, t)], "k long, x long, updated_at timestamp_ntz"), path, key=["k"], run_id="run-0")
    assert read_current(spark, path, ["k"]).first().x == 3


def test_empty_first_run_is_readable(spark):
    ddl = "k long, at timestamp_ntz, updated_at timestamp_ntz"
    for day_col in (None, "at"):
        path = scratch_path(spark, "t-empty")
        append(spark.createDataFrame([], ddl), path, key=["k"], order_by=["k"], run_id="run-1", day_col=day_col)
        got = read_current(spark, path, ["k"])
        assert got.columns == ["k", "at", "updated_at"] and got.collect() == []
        assert compact(spark, path, ["k"]) is None
        row = (1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
        append(spark.createDataFrame([row], ddl), path, key=["k"], order_by=["k"], run_id="run-2", day_col=day_col)
        assert [tuple(r) for r in read_current(spark, path, ["k"]).collect()] == [row]


def test_day_files_are_sorted_and_a_big_day_is_several_files(spark):
    import glob

    import pyarrow.parquet as pq

    from quorum.plans.tables import write_source
    from quorum.sources.adapters import Fixture
    from tests.conftest import SMALL

    fx = Fixture(spark, SMALL)
    path = scratch_path(spark, "t-sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the day were large
    append(fx.table("events"), path, key=["user_id"], order_by=["ts", "event_id"], run_id="run-1", day_col="ts")
    files = glob.glob(f"{path}/run_id=run-1/day=2024-01-10/*.parquet")
    assert len(files) > 1
    for f in files:
        t = pq.read_table(f, columns=["ts", "event_id"]).to_pandas()
        assert (t.sort_values(["ts", "event_id"]).index == t.index).all()
    root = scratch_path(spark, "t-sorted-source")
    one_day = fx.attestation.filter("to_date(event_date_time) = date'2024-01-10'")
    write_source(one_day, root, "beacon_api_eth_v1_events_attestation")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{root}/*/day=*/*.parquet")
    assert len(files) > 1
    for f in files:
        t = pq.read_table(f, columns=["slot_start_date_time"]).to_pandas().slot_start_date_time
        assert t.is_monotonic_increasing


def test_day_partitions_prune_and_compact_only_touched_days(spark):
    path = scratch_path(spark, "t-days")
    d1, d2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    ddl = "slot_started_at timestamp_ntz, k long, x long, updated_at timestamp_ntz"
    append(spark.createDataFrame([(d1, 1, 10, t1), (d2, 2, 20, t1)], ddl), path,
           key=["k"], order_by=["slot_started_at", "k"], run_id="r1", day_col="slot_started_at")
    append(spark.createDataFrame([(d2, 2, 21, t2)], ddl), path,
           key=["k"], order_by=["slot_started_at", "k"], run_id="r2", day_col="slot_started_at")
    key = ["slot_started_at", "k"]
    assert {r.k: r.x for r in read_current(spark, path, key).collect()} == {1: 10, 2: 21}
    only_d2 = read_current(spark, path, key, days=["2024-01-02"])
    assert [(r.k, r.x) for r in only_d2.collect()] == [(2, 21)]
    assert "day" not in only_d2.columns
    plan = only_d2._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*isnotnull\(day", plan)
    compact(spark, path, key)
    assert {r.k: r.x for r in read_current(spark, path, key).collect()} == {1: 10, 2: 21}
    plan = read_current(spark, path, key, days=["2024-01-02"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*isnotnull\(day", plan)
    assert [(r.k, r.x) for r in read_current(spark, path, key, days=["2024-01-02"]).collect()] == [(2, 21)]
