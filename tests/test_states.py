"""Stored partial groups against a recomputation over the whole history."""

import pytest
from pyspark.sql import functions as F

from quorum.operators.states import append_states, compact_states, read_states
from quorum.operators.versioned import read_current
from quorum.plans import models as M
from quorum.plans.runner import merged_run, run_model
from quorum.plans.tables import FrameSources
from quorum.session import scratch_path
from quorum.sources.adapters import Fixture
from quorum.sources.scan import RunWindow
from tests.conftest import SMALL

RUN = "2024-02-01 00:00:00"
YEARS = [RunWindow.of(f"{y}-01-01 00:00:00", f"{y + 2}-01-01 00:00:00") for y in range(1994, 2004, 2)]


def rows(df):
    return sorted(map(str, df.drop("updated_at").collect()))


@pytest.mark.parametrize("name,build", [("transaction_sightings", M.transaction_sightings),
                                        ("transaction_block_native", M.transaction_block_native)])
def test_windows_in_any_order_merge_to_the_whole_history(spark, name, build):
    fx, kept = Fixture(spark, SMALL), M.MODELS[name].merges
    path = scratch_path(spark, f"t-{name}")
    for i in (3, 0, 4, 1, 2, 3):            # out of order, one window twice, edges read by both
        append_states(kept.of_window(fx, YEARS[i]), path, kept.on, f"run-{i}")
        if i == 4:
            assert compact_states(spark, path, kept.key, kept.minima, kept.on)
    want = rows(build(fx, RunWindow.backfill(), RUN))
    assert rows(kept.finish(read_states(spark, path, kept.key, kept.minima, kept.on), RUN)) == want
    compact_states(spark, path, kept.key, kept.minima, kept.on)
    assert rows(kept.finish(read_states(spark, path, kept.key, kept.minima, kept.on), RUN)) == want


def test_a_run_finishes_what_it_touched_without_the_history(spark):
    fx = Fixture(spark, SMALL)
    path = scratch_path(spark, "t-run")
    for i, window in enumerate(YEARS):
        out = merged_run(spark, "transaction_sightings", fx, window, RUN, path, f"run-{i}")
    assert all("/run_id=run-" in f for f in out.inputFiles())
    want = M.transaction_sightings(fx, RunWindow.backfill(), RUN)
    touched = M.transaction_sightings(fx, YEARS[-1], RUN).select("hash")
    assert rows(out) == rows(want.join(touched, "hash", "left_semi").select(*want.columns))


def test_incremental_runs_keep_whole_rollups(spark):
    """The table of runs over two windows equals one run over both; without state the second
    window's rows would replace the first's."""
    fx, root = Fixture(spark, SMALL), scratch_path(spark, "t-incremental")
    model = M.MODELS["transaction_sightings"]
    for now in ("1998-01-01 00:00:00", "2002-01-01 00:00:00"):
        run_model(spark, model, fx, f"{root}/out", f"{root}/meta", now, interval="4 YEAR", state_path=f"{root}/states")
    want = model.build(fx, RunWindow.of("1994-01-01 00:00:00", "2002-01-01 00:00:00"), RUN)
    assert rows(read_current(spark, f"{root}/out", model.key)) == rows(want)
    with pytest.raises(ValueError, match="no mergeable state"):
        merged_run(spark, "transaction_hashes", fx, YEARS[0], RUN, root, "r")


def sightings(spark, rows):
    """Mempool rows of (hash, observer, continent, time) whose other attributes are alike."""
    df = spark.createDataFrame(rows, "hash string, meta_client_name string, meta_client_geo_continent_code string, at string")
    return FrameSources({"mempool_transaction": df.withColumns({
        "event_date_time": F.col("at").cast("timestamp_ntz"), "meta_network_name": F.lit("mainnet"),
        "nonce": F.lit(1).cast("decimal(20,0)")}).drop("at")})


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rollups_send_a_transaction_once(spark):
    rows = [("0xab", f"s{i % 3}", None if i % 5 else "EU", f"2024-01-01 00:00:{i % 60:02d}") for i in range(200)]
    rows += [("0xAB", None, "AS", "2024-01-02 00:00:00"), ("no hex", "s0", None, "2024-01-02 00:00:00")]
    out = M.transaction_sightings(sightings(spark, rows), RunWindow.backfill(), RUN)
    assert exchanges(out) == 1
    got = {r["hash"]: (r.total_seen_by_sentries, r.seen_continents, str(r.first_seen_at)) for r in out.collect()}
    assert got == {"0xab": (3, ["EU"], "2024-01-01 00:00:00"), "0xAB": (0, ["AS"], "2024-01-02 00:00:00"),
                   "no hex": (1, [], "2024-01-02 00:00:00")}
    life = M.transaction_block_native(Fixture(spark, SMALL), RunWindow.backfill(), RUN)
    assert exchanges(life) == 3                 # line items, orders, groups


def test_stored_groups_are_rows_of_sets_that_merge_without_an_exchange(spark):
    """One row per transaction and run; reading the runs' buckets together, and compacting them."""
    kept, path = M.MODELS["transaction_sightings"].merges, scratch_path(spark, "t-buckets")
    for run in range(3):
        some = [(f"0x{i:04x}", f"s{run}-{j}", "EU", f"2024-01-0{run + 1} 00:00:0{j}") for i in range(50) for j in range(4)]
        append_states(kept.partial(sightings(spark, some).get("mempool_transaction")), path, kept.on, f"run-{run}", kept.key)
    merged = read_states(spark, path, kept.key, kept.minima, kept.on)
    assert exchanges(merged) == 0
    assert merged.count() == 50 and {r[0] for r in kept.finish(merged, RUN).select("total_seen_by_sentries").collect()} == {12}
    base = compact_states(spark, path, kept.key, kept.minima, kept.on)
    assert spark.read.parquet(f"{path}/run_id={base}").count() == 50
    assert rows(kept.finish(read_states(spark, path, kept.key, kept.minima, kept.on), RUN)) == rows(kept.finish(merged, RUN))


def test_a_run_finishes_the_other_groups_of_its_hashes(spark):
    """A hash with two attribute sets, of which the run has partials of one; a NULL hash goes."""
    kept, path = M.MODELS["transaction_sightings"].merges, scratch_path(spark, "t-others")

    def add(run, rows):
        df = spark.createDataFrame(rows, "hash string, type short, meta_client_name string, at string")
        df = FrameSources({"mempool_transaction": df.withColumn("event_date_time", F.col("at").cast("timestamp_ntz")).drop("at")}).get("mempool_transaction")
        append_states(kept.partial(df), path, kept.on, run, kept.key)

    at = "2024-01-01 00:00:00"
    add("run-0", [("0x0a", 1, "a", at), ("0x0a", 2, "b", at), ("0x0b", 1, "c", at), (None, 1, "d", at)])
    add("run-1", [("0x0a", 1, "e", at), (None, 1, "f", at)])
    out = kept.finish(read_states(spark, path, kept.key, kept.minima, kept.on, touched_by="run-1"), RUN)
    assert sorted((r["hash"], r["type"], r.total_seen_by_sentries) for r in out.collect()) == [("0x0a", 1, 2), ("0x0a", 2, 1)]
