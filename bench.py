"""Benchmark: the twelve jobs (+ the nearest join) at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows reach the driver), once to
warm up, then ``$BENCH_RUNS`` times; the median is reported.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "reconcile_blocks", "reconcile_blob_counts", "divergence", "participation_rate",
    "members_by_nearest_class", "missing_members_by_class", "first_reporter",
    "tx_sightings", "tx_lifecycle", "tx_distinct_external", "tx_distinct_canonical",
    "tx_hash_universe", "nearest_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from quorum.plans.queries import QUERIES
    from quorum.session import build_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 4)))
    spark = build_session(f"local[{cpus}]", app="quorum-bench", shuffle_partitions=parts,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g"),
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
                                 **json.loads(os.environ.get("BENCH_CONF", "{}"))})
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        q = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
