"""Helpers shared by the operators: lineage cuts, Arrow columns, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.session import scratch_path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Later stages then start from files that every executor sees, so a lost executor costs
    its own tasks only.
    """
    return cut_at(df, name)[0]


def cut_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``cut`` with the table's path, for a caller that deletes it later."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ``cut_at`` that nothing reads any more (a round's state whose
    successor is written), through the file system that its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shared_files(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a shared path, and the path within it, for reads inside tasks."""
    uri = path if "://" in path or path.startswith("file:") else "file://" + path
    return pafs.FileSystem.from_uri("s3://" + uri[6:] if uri.startswith("s3a://") else uri)


def binaries(column: pa.Array) -> list[bytes | None]:
    """A string (or binary) Arrow column as bytes objects."""
    return column.cast(pa.large_binary()).to_pylist()


# What a Python worker may keep from one task to the next, by operator.
_KEPT: dict[str, Callable[[], None]] = {}
_last: list[str] = [""]


def keeps(operator: str, forget: Callable[[], None]) -> None:
    """Register how to empty what tasks of ``operator`` leave for its next task."""
    _KEPT[operator] = forget


def tidy(operator: str, run: Callable) -> Callable:
    """``run`` (of ``mapInArrow`` or ``applyInArrow``) as a task that bounds its worker.

    Workers are reused: a task first empties what other operators have left (memos, tables),
    and hands freed memory back to the system when it ends, so that the stages of one job do
    not add up in an executor.
    """
    def enter() -> None:
        if _last[0] != operator:
            for other, forget in _KEPT.items():
                if other != operator:
                    forget()
            _last[0] = operator

    def rows(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter()
        try:
            yield from run(batches_)
        finally:
            _release()

    def group(table: pa.Table) -> pa.Table:
        enter()
        try:
            return run(table)
        finally:
            _release()

    return group if isinstance(run, _Group) else rows


class _Group:
    """Marks a function of ``applyInArrow`` for ``tidy``."""

    def __init__(self, run: Callable) -> None:
        self.run = run

    def __call__(self, table: pa.Table) -> pa.Table:
        return self.run(table)


def tidy_group(operator: str, run: Callable) -> Callable:
    return tidy(operator, _Group(run))


def _release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # a system whose C library has no such call
        pass


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash ``df`` by ``keys`` over the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def batches(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` rows."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` with the smallest node of each connected component.

    ``edges`` holds integer pairs; self links and repeats are allowed, nodes without any
    link do not appear.  Alternating large-star and small-star rounds: every round points
    each node at the smallest node it knows of, so the number of rounds follows the
    logarithm of the longest chain.  A hub's neighbours meet it in an equi-join, which AQE
    splits, and its minimum is a partial aggregate.  Each round is written to the shared
    folder; only two numbers per round reach the driver.
    """
    cur = cut(edges.select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo"))
              .filter("hi <> lo").distinct(), "edges")
    state = _fingerprint(cur)
    while True:
        if not state[0]:
            break
        both = cur.union(cur.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("hub")).agg(F.min("lo").alias("m")) \
            .select("hub", F.least("hub", "m").alias("m"))
        large = both.filter("lo > hi").join(least, F.col("hi") == F.col("hub")) \
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
        large = cut(large, "large-star")
        least = large.groupBy(F.col("hi").alias("hub")).agg(F.min("lo").alias("m"))
        small = large.join(least, F.col("hi") == F.col("hub")) \
            .select(F.explode(F.array(
                F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                F.struct(F.col("hub").alias("hi"), F.col("m").alias("lo")))).alias("e")) \
            .select("e.hi", "e.lo").filter("hi <> lo").distinct()
        cur = cut(small, "small-star")
        now = _fingerprint(cur)
        if now == state:
            break
        state = now
    roots = cur.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
