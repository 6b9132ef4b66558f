"""Plan-level guarantees: no operator pairs rows within a key, filters reach the scan."""

import re

import pytest

import __spark_entry__ as E
from quorum.plans.queries import QUERIES
from tests.conftest import SMALL

# Registered from the core library; the ones that write and read tables run jobs when built.
SIDE_EFFECTS = {"compact_replacing", "incremental_replay", "stream_participation",
                "stream_first_reporter", "catch_up_replay", "compacted_read", "sorted_append", "bucketed_participation"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_of(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


@pytest.mark.parametrize("name", ["reconcile_blocks", "reconcile_blob_counts"])
def test_reconciliation_pairs_no_roots(spark, name):
    plan = plan_of(E.queries()[name](spark, SMALL))
    assert "FullOuter" not in plan, plan


def test_nearest_join_joins_only_on_ranges(spark):
    plan = plan_of(E.queries()["nearest_join"](spark, SMALL))
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[([^\]]*)\]", plan)
    assert joins, plan
    for keys in joins:
        if "_k0" in keys:                       # the join inside the operator
            assert "_rng" in keys, keys


def test_window_bounds_are_pushed_to_the_scan(spark):
    plan = plan_of(E.queries()["window_scan"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan), plan
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(ts,", plan), plan


@pytest.mark.parametrize("name,scans", [("nearest_join", 2), ("members_by_nearest_class", 2), ("missing_members_by_class", 4)])
def test_nearest_join_runs_its_left_side_once(spark, name, scans):
    """Scans of the events table: one per source (the committee source reads it twice)."""
    df = E.queries()[name](spark, SMALL)
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan, plan
    assert len(re.findall(r"FileScan parquet \[event_id", plan)) == scans, plan


@pytest.mark.parametrize("name", ["tx_sightings", "divergence", "tx_hash_universe"])
def test_plan_does_not_switch_on_size(spark, name):
    """No input is dealt anew because of its size: the exchanges by key are the same."""
    def exchanges(sf):
        plan = plan_of(E.queries()[name](spark, sf))
        assert "RoundRobin" not in plan
        return len(re.findall(r"Exchange hashpartitioning\([^)]*\), ENSURE_REQUIREMENTS", plan))

    assert exchanges("/root/testdata/sf0.01") == exchanges("/root/testdata/sf0.1")


def test_reconciliation_puts_no_set_on_rollup_rows(spark):
    """M1 collects a source's roots once per key; no set stands under a window."""
    plan = plan_of(E.queries()["reconcile_blocks"](spark, SMALL))
    assert "Window" not in plan and "collect_set" in plan, plan


def test_bucketed_sources_need_no_exchange(spark):
    """M4 reads its two bucketed sources as they lie: aggregates and join above the scans."""
    df = E.queries()["bucketed_participation"](spark, SMALL)
    want = QUERIES["participation_rate"](spark, SMALL)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    plan = plan_of(df)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") >= 2, plan
