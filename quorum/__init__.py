"""quorum: incremental analytics over append-only, multi-observer telemetry on Spark.

Layers
------
sources/    typed source catalog, windowed scans, fixture adapters over the driver tables
functions/  column-level helpers (surrogate keys, interval literals, set rendering)
operators/  parameterised DataFrame operators (latest-version reads, nearest join,
            reconciliation, unanimity, participation, missing members, first reporter,
            distinct rollups, partial-state merge)
plans/      the twelve telemetry jobs as compositions of operators, run windows and the
            incremental runner (resolve window -> build -> append -> commit)
streaming/  Structured Streaming drivers (availableNow + foreachBatch) and tumbling slots
oracle/     independent DuckDB SQL for every registered query (correctness gate)
"""

__version__ = "0.1.0"
