"""Withdrawn keys, schemas over time, compaction of touched days, retention."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quorum.operators import versioned as V
from quorum.session import delete_path, scratch_path

D1, D2, D3 = (dt.datetime(2024, 1, d, 6) for d in (1, 2, 3))
T = [dt.datetime(2024, 2, d) for d in range(1, 9)]
DDL = "slot_started_at timestamp_ntz, k long, x long, updated_at timestamp_ntz"
KEY = ["slot_started_at", "k"]


def put(spark, path, rows, run, day_col="slot_started_at"):
    return V.append(spark.createDataFrame(rows, DDL), path, KEY, KEY, run, day_col=day_col)


def current(spark, path, **kw):
    return sorted((r.slot_started_at.day, r.k, r.x) for r in V.read_current(spark, path, KEY, **kw).collect())


def replace(spark, path, rows, run, t, days, day_col="slot_started_at"):
    """``rows`` are all that the table holds on ``days``."""
    V.replace_scope(spark.createDataFrame([(*r, t) for r in rows], DDL), path, KEY,
                    lambda df: df.filter(F.to_date("slot_started_at").isin([d.date() for d in days])), F.lit(t),
                    order_by=KEY, run_id=run, day_col=day_col, days=lambda d: d in {x.date() for x in days})


@pytest.mark.parametrize("day_col", ["slot_started_at", None])
def test_keys_that_a_recomputed_scope_no_longer_yields_are_withdrawn(spark, day_col):
    path = scratch_path(spark, "t-withdraw")
    replace(spark, path, [(D1, 1, 10), (D1, 2, 20), (D2, 3, 30)], "r1", T[0], [D1, D2], day_col)
    replace(spark, path, [(D1, 1, 11), (D1, 4, 40)], "r2", T[1], [D1], day_col)
    assert current(spark, path) == [(1, 1, 11), (1, 4, 40), (2, 3, 30)]
    # a retried run changes nothing, a key may come back, and an empty result empties its scope
    replace(spark, path, [(D1, 1, 11), (D1, 4, 40)], "r2", T[1], [D1], day_col)
    assert current(spark, path) == [(1, 1, 11), (1, 4, 40), (2, 3, 30)]
    replace(spark, path, [(D1, 2, 21)], "r3", T[2], [D1], day_col)
    assert current(spark, path) == [(1, 2, 21), (2, 3, 30)]
    V.compact(spark, path, KEY)
    assert current(spark, path) == [(1, 2, 21), (2, 3, 30)]
    replace(spark, path, [], "r4", T[3], [D1, D2], day_col)
    assert current(spark, path) == []
    V.compact(spark, path, KEY)
    assert current(spark, path) == []


def test_null_keys_are_replaced_and_withdrawn(spark):
    path = scratch_path(spark, "t-null")
    def run(rows, name, t):
        V.replace_scope(spark.createDataFrame([(*r, t) for r in rows], "k long, x long, updated_at timestamp_ntz"),
                        path, ["k"], lambda df: df, F.lit(t), run_id=name)
    run([(None, 1), (2, 2)], "r1", T[0])
    run([(None, 5)], "r2", T[1])
    assert [(r.k, r.x) for r in V.read_current(spark, path, ["k"]).collect()] == [(None, 5)]
    run([(2, 3)], "r3", T[2])
    assert [(r.k, r.x) for r in V.read_current(spark, path, ["k"]).collect()] == [(2, 3)]


def test_a_column_of_a_later_run_is_read_and_a_changed_type_is_an_error(spark):
    path = scratch_path(spark, "t-schema")
    V.append(spark.createDataFrame([(1, 10, T[0])], "k long, x long, updated_at timestamp_ntz"), path, ["k"], run_id="r1")
    V.append(spark.createDataFrame([(2, 20, T[1], "new")], "k long, x long, updated_at timestamp_ntz, note string"),
             path, ["k"], run_id="r2")
    V.append(spark.createDataFrame([(3, T[2])], "k long, updated_at timestamp_ntz"), path, ["k"], run_id="r3")
    got = V.read_current(spark, path, ["k"])
    assert got.columns == ["k", "x", "updated_at", "note"]
    want = {(1, 10, None), (2, 20, "new"), (3, None, None)}
    assert {(r.k, r.x, r.note) for r in got.collect()} == want
    V.compact(spark, path, ["k"])
    assert {(r.k, r.x, r.note) for r in V.read_current(spark, path, ["k"]).collect()} == want
    V.append(spark.createDataFrame([("4", T[3])], "k string, updated_at timestamp_ntz"), path, ["k"], run_id="r4")
    with pytest.raises(ValueError, match="column k is bigint in earlier runs and string in r4"):
        V.read_current(spark, path, ["k"])


def test_a_run_is_seen_when_its_record_is(spark):
    path = scratch_path(spark, "t-half")
    put(spark, path, [(D1, 1, 10, T[0])], "r1")
    put(spark, path, [(D1, 1, 11, T[1])], "r2")
    delete_path(spark, f"{path}/{V.RUNS}/r2")      # as if the run had died before its record
    assert current(spark, path) == [(1, 1, 10)]


def test_compaction_writes_touched_days_only_and_reads_list_no_dead_run(spark):
    path = scratch_path(spark, "t-touched")
    put(spark, path, [(D1, 1, 10, T[0]), (D2, 2, 20, T[0]), (D3, 3, 30, T[0])], "r1")
    put(spark, path, [(D1, 1, 11, T[1]), (D2, 2, 21, T[1])], "r2")
    first = V.compact(spark, path, KEY)
    assert V.compact(spark, path, KEY) is None
    put(spark, path, [(D2, 5, 50, T[2])], "r3")     # one late day
    second = V.compact(spark, path, KEY)
    assert [d for d in sorted(os.listdir(f"{path}/run_id={second}")) if d.startswith("day")] == ["day=2024-01-02"]
    want = [(1, 1, 11), (2, 2, 21), (2, 5, 50), (3, 3, 30)]
    assert current(spark, path) == want
    read = V.read_current(spark, path, KEY)
    listed = {f.split("run_id=")[1].split("/part")[0] for f in read.inputFiles()}
    assert listed == {f"{first}/day=2024-01-01", f"{second}/day=2024-01-02", f"{first}/day=2024-01-03"}
    # retention: what bases replaced goes, whenever the job dies
    assert V.retire(spark, path, before=dt.datetime(2000, 1, 1)) == 0
    assert V.retire(spark, path) == 7       # 3 days of r1, 2 of r2, 1 of r3, 1 of the first base
    assert current(spark, path) == want and V.retire(spark, path) == 0 or current(spark, path) == want
    assert sorted(os.listdir(path)) == ["_runs", f"run_id={first}", f"run_id={second}"] or \
        not any(os.path.exists(f"{path}/run_id=r{i}/day=2024-01-01") for i in (1, 2, 3))
    put(spark, path, [(D1, 1, 12, T[3])], "r4")
    V.compact(spark, path, KEY)
    V.retire(spark, path)
    assert current(spark, path) == [(1, 1, 12), *want[1:]]


def test_retention_that_dies_at_any_step_reads_the_same(spark, monkeypatch):
    steps = 0
    while True:
        path = scratch_path(spark, "t-dies")
        for i, rows in enumerate(([(D1, 1, 10, T[0]), (D2, 2, 20, T[0])], [(D1, 1, 11, T[1])])):
            put(spark, path, rows, f"r{i}")
        V.compact(spark, path, KEY)
        put(spark, path, [(D1, 7, 70, T[2])], "r7")
        V.compact(spark, path, KEY)
        left = [steps]

        def dying(s, p, left=left):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            delete_path(s, p)
        monkeypatch.setattr(V, "delete_path", dying)
        try:
            V.retire(spark, path)
            done = True
        except RuntimeError:
            done = False
        assert current(spark, path) == [(1, 1, 11), (1, 7, 70), (2, 2, 20)], steps
        if done:
            assert steps > 3
            return
        steps += 2


def test_rows_without_a_day_are_kept(spark):
    path = scratch_path(spark, "t-noday")
    put(spark, path, [(None, 1, 10, T[0]), (D1, 2, 20, T[0])], "r1")
    put(spark, path, [(None, 1, 11, T[1])], "r2")
    got = lambda: sorted((r.k, r.x) for r in V.read_current(spark, path, KEY).collect())
    assert got() == [(1, 11), (2, 20)]
    V.compact(spark, path, KEY)
    assert got() == [(1, 11), (2, 20)]
