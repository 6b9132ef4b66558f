"""Run-window resolution and commit: the three cases, the read cap, month arithmetic."""

import datetime as dt

from quorum.plans.runwindow import commit_rows, empty_meta, resolve_window, resolve_windows

D = dt.datetime


def meta(spark, rows):
    return spark.createDataFrame(rows, "model string, updated_date_time timestamp_ntz, "
                                       "last_run_date_time timestamp_ntz")


def test_never_ran(spark):
    w, nxt = resolve_window(spark, empty_meta(spark), "m", "2024-03-01 12:00:00", "1 DAY")
    assert (w.start, w.end, nxt) == (D(2024, 2, 29, 12), D(2024, 3, 1, 12), D(2024, 3, 1, 12))


def test_catch_up_reads_what_it_commits(spark):
    m = meta(spark, [("m", D(2024, 1, 1), D(2024, 1, 1, 10)), ("m", D(2024, 1, 2), D(2024, 1, 2))])
    w, nxt = resolve_window(spark, m, "m", "2024-01-10 00:00:00", "1 DAY")
    assert (w.start, w.end, nxt) == (D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 3))


def test_read_cap_reproduces_reference(spark):
    m = meta(spark, [("m", D(2024, 1, 2), D(2024, 1, 2))])
    w, nxt = resolve_window(spark, m, "m", "2024-01-10 00:00:00", "1 DAY", read_cap="1 HOUR")
    assert (w.start, w.end, nxt) == (D(2024, 1, 2), D(2024, 1, 2, 1), D(2024, 1, 3))


def test_capped_by_now(spark):
    m = meta(spark, [("m", D(2024, 1, 2), D(2024, 1, 2))])
    w, nxt = resolve_window(spark, m, "m", "2024-01-02 00:30:00", "1 DAY", read_cap="1 HOUR")
    assert (w.end, nxt) == (D(2024, 1, 2, 0, 30), D(2024, 1, 2, 0, 30))


def test_month_interval_clamps(spark):
    m = meta(spark, [("m", D(2024, 1, 31), D(2024, 1, 31))])
    _, nxt = resolve_window(spark, m, "m", "2024-06-01 00:00:00", "1 MONTH")
    assert nxt == D(2024, 2, 29)


def test_commit_rows(spark):
    models = spark.createDataFrame([("a",), ("b",)], "model string")
    m = meta(spark, [("a", D(2024, 1, 1), D(2024, 1, 1))])
    rows = {r.model: r for r in commit_rows(resolve_windows(models, m, "2024-01-05 00:00:00.7", "1 DAY"),
                                            "2024-01-05 00:00:00.7").collect()}
    assert rows["a"].last_run_date_time == D(2024, 1, 2)
    assert rows["b"].last_run_date_time == D(2024, 1, 5)   # never ran: now, whole seconds


def test_window_text_and_unparsable_now(spark):
    from quorum.plans.runwindow import window_text
    models = spark.createDataFrame([("a",)], "model string")
    w = window_text(resolve_windows(models, empty_meta(spark), "2024-01-05 10:00:00", "1 HOUR")).first()
    assert (w.start_time, w.end_time) == ("2024-01-05 09:00:00", "2024-01-05 10:00:00")
    bad = resolve_windows(models, empty_meta(spark), "not a time", "1 HOUR").first()
    assert bad.start_time is None and bad.end_time is None


def test_no_step_passes_through_the_session_zone(spark):
    """02:30 on the night the clocks go forward does not exist in that zone."""
    from pyspark.sql import functions as F

    from quorum.functions.timefns import format_ts, parse_ts_or_null, truncate_to_second
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:05.75' AS t")
        r = df.select(truncate_to_second("t").alias("s"), format_ts("t").alias("f"),
                      parse_ts_or_null(F.lit("2024-03-10 02:30:05")).alias("p")).first()
        windows = resolve_windows(spark.createDataFrame([("m",)], "model string"), empty_meta(spark), "2024-03-10 02:30:00", "1 HOUR")
        w = windows.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    whole = dt.datetime(2024, 3, 10, 2, 30, 5)
    assert (r.s, r.f, r.p) == (whole, "2024-03-10 02:30:05", whole)
    assert (w.start_time, w.end_time) == (dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 2, 30))
