"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from quorum.plans.queries import QUERIES
from tests.conftest import SMALL

KEYS = sorted(QUERIES)     # the core library's; tests/llm has the optional package's


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    from quorum.oracle.compare import compare
    ok, msg = compare(E.queries()[name](spark, SMALL), duck, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "participation_rate" in df.columns


@pytest.mark.parametrize("name", ["window_scan", "run_window", "run_commit", "slot_tumbling",
                                  "tx_distinct_external", "participation_rate",
                                  "reconcile_blocks", "display_times", "catch_up_replay"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    from quorum.oracle.compare import compare
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ok, msg = compare(E.queries()[name](spark, SMALL), duck, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert ok, msg
