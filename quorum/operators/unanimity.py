"""M3 core, A4 / A8 / A11 / J6: do the reports of each client agree?

For every group (slot, committee, ...) and client, reports are counted per distinct vote
(the vote columns themselves are the fingerprint; no hash is needed to group).  A client
is *unanimous* in a group when its most frequent vote has all of its reports.

The source system joins one aggregate to itself at three grains; here it is two grouped
aggregations and, for the reference semantics, one window -- after a single repartition
on the match keys, every later stage reuses that partitioning (no further shuffle).

``scope='reference'`` reproduces the source system: the total a client's top count is
compared with is looked up by (slot, committee, client) only, so the totals of *another
network* with the same slot number can make a client look unanimous.
``scope='network'`` compares within the same group (the evident intent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The five clients whose agreement is reported, in output order.
CLIENTS = ("prysm", "teku", "lodestar", "lighthouse", "nimbus")


def vote_counts(df: DataFrame, group: Sequence[str], client: str, vote: Sequence[str],
                match_keys: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*group, client, *vote).agg(F.count(F.lit(1)).alias("cnt"))
    # every later aggregation / window groups by a superset of match_keys
    return counts.repartition(*match_keys)


def unanimity(df: DataFrame, group: Sequence[str], client: str, vote: Sequence[str],
              match_keys: Sequence[str], clients: Sequence[str] = CLIENTS,
              scope: str = "reference") -> DataFrame:
    """One row per group: ``<client>_all_equal`` flags and ``all_equal`` (1 iff all are 1)."""
    group, match_keys = list(group), list(match_keys)
    per_client = (vote_counts(df, group, client, vote, match_keys)
                  .groupBy(*group, client)
                  .agg(F.max("cnt").alias("maxcnt"), F.sum("cnt").alias("totalcnt")))
    if scope == "reference":
        totals = F.collect_set("totalcnt").over(Window.partitionBy(*match_keys, client))
        ok = F.array_contains(totals, F.col("maxcnt"))
    elif scope == "network":
        ok = F.col("maxcnt") == F.col("totalcnt")
    else:
        raise ValueError(f"scope must be 'reference' or 'network', not {scope!r}")
    per_client = per_client.withColumn("_ok", ok)
    flags = [F.max(F.when((F.col(client) == c) & F.col("_ok"), 1).otherwise(0)).cast("int")
             .alias(f"{c}_all_equal") for c in clients]
    out = per_client.groupBy(*group).agg(*flags)
    every = None
    for c in clients:
        cond = F.col(f"{c}_all_equal") == 1
        every = cond if every is None else every & cond
    return out.withColumn("all_equal", F.when(every, 1).otherwise(0).cast("int"))


def top_variant(df: DataFrame, group: Sequence[str], client: str, vote: Sequence[str],
                match_keys: Sequence[str]) -> DataFrame:
    """argMax(vote, count) per (group, client): the most reported vote and its count.
    Ties go to the greatest vote (deterministic)."""
    counts = vote_counts(df, group, client, vote, match_keys)
    best = F.max(F.struct(F.col("cnt"), *[F.col(v) for v in vote]))
    out = counts.groupBy(*group, client).agg(best.alias("_b"))
    return out.select(*group, client, *[F.col(f"_b.{v}").alias(v) for v in vote],
                      F.col("_b.cnt").alias("maxcnt"))
