"""Command line: run the jobs incrementally, like a scheduled transformation run.

    python -m quorum.cli run --sources /data/sources --out /data/out \
        [--models blocks,network_participation] [--now "2024-01-31 00:00:00"] [--threads 4]
        [--read-cap "1 HOUR"]

Sources are Parquet datasets ``<sources>/<source name>/`` with the catalog's columns.
Outputs go to ``<out>/<model>/`` (replacing tables) and ``<out>/model_metadata/``.
Under spark-submit the session comes from the submit configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt

from quorum.plans.models import MODELS
from quorum.plans.runner import run_models
from quorum.plans.tables import ParquetSources


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="quorum")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="one incremental run of each model")
    run.add_argument("--sources", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--models", default=",".join(MODELS))
    run.add_argument("--now", default=None, help="run start (default: now, UTC, seconds)")
    run.add_argument("--threads", type=int, default=4)
    run.add_argument("--read-cap", default=None)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from quorum.session import DEFAULT_CONF
    builder = SparkSession.builder.appName("quorum")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    results = run_models(spark, args.models.split(","), ParquetSources(spark, args.sources),
                         args.out, now, threads=args.threads, read_cap=args.read_cap)
    failed = 0
    for name, res in results.items():
        if isinstance(res, Exception):
            failed += 1
            print(f"{name}: FAILED {res}")
        else:
            window, committed = res
            print(f"{name}: read [{window.start}, {window.end}] committed {committed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
