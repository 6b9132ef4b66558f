"""Session construction and session-derived settings.

Library code never creates its own session: every entry point receives one.  The helpers
here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC so that wall-clock slot arithmetic is stable, ANSI so
# that overflow / bad casts fail loudly, AQE for runtime coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "quorum",
                  shuffle_partitions: int | None = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, sinks of replays and streaming checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file system), and
    a session without that setting is an error: a private folder would leave each executor's
    part of a table on its own disk.  Only a local master, where driver and executors are
    one process, gets a temporary folder, registered so that later calls agree on it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current and sc is not None:
            sc.setCheckpointDir(current)
    if not current:
        master = spark.conf.get("spark.master", "") or ""
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master is {master or 'unknown'})")
        current = tempfile.mkdtemp(prefix="quorum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through the file system that its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
