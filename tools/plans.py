"""Print a plan summary per registered query: shuffles, joins, windows, scans.

usage: python tools/plans.py [sf_dir] [query ...]   (add --full to print whole plans)
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window",
         "WindowGroupLimit", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "Expand", "Generate", "Union", "BatchEvalPython", "ArrowEvalPython"]


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    s = ", ".join(f"{k}={v}" for k, v in sorted(counts(df).items()))
    for cols, pushed in scans:
        s += f"\n    scan cols={len(cols.split(','))} pushed=[{pushed[:120]}]"
    return s


def counts(df) -> Counter:
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = Counter()
    for line in plan.splitlines():
        name = re.sub(r"^[\s:+\-*()0-9]*", "", line).split(" ")[0].split("(")[0]
        if name in NODES:
            c[name] += 1
    return c


def markdown(spark, sf_dir, names) -> str:
    from quorum.plans.queries import QUERIES
    cols = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "Window",
            "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Generate", "Union"]
    out = ["| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name in names:
        c = counts(QUERIES[name](spark, sf_dir))
        out.append(f"| {name} | " + " | ".join(str(c.get(k, 0)) for k in cols) + " |")
    return "\n".join(out)


def main():
    if "--markdown" in sys.argv:
        from quorum.plans.queries import QUERIES
        from quorum.session import build_session
        spark = build_session("local[8]")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        skip = {"compact_replacing", "incremental_replay", "stream_participation",
                "stream_first_reporter"}
        print(markdown(spark, "/root/testdata/sf0.01", [q for q in QUERIES if q not in skip]))
        return
    args = [a for a in sys.argv[1:] if a != "--full"]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from quorum.plans.queries import QUERIES
    from quorum.session import build_session
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the static plan
    for name in names or list(QUERIES):
        if name in ("compact_replacing", "incremental_replay", "stream_participation"):
            continue
        df = QUERIES[name](spark, sf_dir)
        print(f"{name}: {summary(df)}")
        if "--full" in sys.argv:
            df.explain("formatted")


if __name__ == "__main__":
    main()
