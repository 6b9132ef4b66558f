"""Mergeable rollup state: partial groups stored per run, merged on read.

A rollup whose groups are seen again in later windows (a transaction's sightings) is kept as
*partial groups*: one row per group and run, with minima and with the sets of what the rollup
collects or counts distinctly (all other columns; a stored row holds the distinct values that
its run saw, as the finished row does).  Such rows merge by ``min`` and set union per key, in
any order and however often a row is read again, so a run adds the partials of its own window
only, and the groups it touched are finished from the stored partials of all runs instead of
from the history of the source.  Compaction merges the partials of many runs into one base.

Runs and bases are stored bucketed by the group's key, so partials are sent over the network
once, when a run groups its window; storing, compacting and merging them need no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.functions.sets import merged_set
from quorum.operators import versioned


def merge_states(df: DataFrame, key: Sequence[str], minima: Sequence[str]) -> DataFrame:
    """One row per ``key`` with the least of each ``minima`` column (NULLs are skipped) and the
    union of each other column, a set."""
    sets = [c for c in df.columns if c not in (*key, *minima, "run_id")]
    return df.groupBy(*key).agg(*[F.min(c).alias(c) for c in minima], *[merged_set(c).alias(c) for c in sets])


def append_states(df: DataFrame, path: str, on: Sequence[str], run_id: str, key: Sequence[str] = ()) -> str:
    """Add a run's partials; files are bucketed by ``key`` (``on`` unless given), sorted by
    ``on`` and carry its Bloom filters."""
    return versioned.append(df, path, key=on, order_by=on, run_id=run_id, bloom=on, buckets=key or on)


def read_states(spark: SparkSession, path: str, key: Sequence[str], minima: Sequence[str],
                on: Sequence[str], touched_by: str | None = None) -> DataFrame:
    """The merged partials; with ``touched_by`` only of groups that this run holds partials of."""
    stored = versioned._versions(spark, path)
    if stored is None:
        raise ValueError(f"{path} holds no states")
    if touched_by is None:
        return merge_states(stored, key, minima)
    stored = stored.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in on]))
    mine = F.col("run_id") == touched_by
    own = merge_states(stored.withColumn("_other", ~mine), key, (*minima, "_other")).withColumn("_own", ~F.col("_other")).drop("_other")
    # Groups without partials of this run that share ``on`` with one that has some: found by
    # ``on`` alone.  They are stored beside the states, so that Spark knows their size; as long
    # as they are few, the wide rows of all groups stay where they lie.
    folder = f"{path.rstrip('/')}/_touched/run_id={touched_by}"
    own.filter(~F.col("_own")).select(*on).join(stored.filter(mine).select(*on), list(on), "left_semi").distinct() \
        .write.mode("overwrite").parquet(folder)
    others = spark.read.schema(stored.select(*on).schema).parquet(folder).withColumn("_other", F.lit(True))
    return own.join(others, list(on), "left").filter("_own or _other").drop("_own", "_other")


def compact_states(spark: SparkSession, path: str, key: Sequence[str], minima: Sequence[str],
                   on: Sequence[str]) -> str | None:
    """Fold the partials of all runs into one base."""
    return versioned.compact(spark, path, key=on, order_by=on, bloom=on, buckets=key,
                             fold=lambda df: merge_states(df, key, minima))
