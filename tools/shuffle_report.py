"""Shuffle bytes and peak execution memory per query, from Spark's event log.

Runs each query once through the ``noop`` sink with event logging into a fresh scratch
folder, tags its jobs with a job group, then sums the task metrics per group.

usage: python tools/shuffle_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402


def _lines(path: str):
    """Event-log lines of a plain or zstd-compressed (rolling) event-log file."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="quorum-eventlog-")
    from quorum.plans.queries import QUERIES
    from quorum.session import build_session
    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.driver.memory": "16g"})
    rows = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        n = df.count()
        df.write.format("noop").mode("overwrite").save()
        rows[name] = {"rows": n, "sec_incl_count": round(time.perf_counter() - t0, 2)}
    spark.stop()
    stage_group, written, peak = {}, {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith(("appstatus", ".")):
            continue
        for line in _lines(path):
            if not line.strip():
                continue
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g
            elif kind == "SparkListenerTaskEnd":
                g = stage_group.get(ev.get("Stage ID"))
                m = ev.get("Task Metrics") or {}
                sw = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                written[g] = written.get(g, 0) + sw
                peak[g] = max(peak.get(g, 0), m.get("Peak Execution Memory", 0))
    for name in names:
        rows[name]["shuffle_mb"] = round(written.get(name, 0) / 2**20, 2)
        rows[name]["peak_task_exec_mem_mb"] = round(peak.get(name, 0) / 2**20, 2)
        print(json.dumps({"query": name, **rows[name]}))


if __name__ == "__main__":
    main()
