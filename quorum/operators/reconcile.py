"""Reconciling several observers of one fact.

Sources report the same (slot, epoch, network) fact, each possibly with several roots.
Each source is first rolled up per (key, root) (one shuffle each, map-side partial
aggregation).  The source system then chains full outer joins on the key, which pairs
every root of one source with every root of the others inside a slot, and regroups.
Both results it computes that way are obtained here *without pairing rows*:

* ``crossed_sightings`` -- the regrouped result of (e FULL JOIN g) FULL JOIN c: groups
  are the start times of the first source present for the key; the other sources, being
  crossed with every row of that source, contribute whole-key aggregates.
* ``precedence_rows`` -- COALESCE(first source, second, ...) over the joined rows: the
  highest-precedence source present for a key supplies every joined row of that key.

Each is one union of the rollups and one shuffle by the key, whose partitioning the later
steps reuse.  ``crossed_sightings`` collects a source's roots once per key and start and puts
them into the result rows after the leading source is known, so no rollup row carries a set;
``precedence_rows`` needs a window over the key's rows for one number.  (Both assume what the
declared schemas guarantee: root, start and count are never NULL in a rollup row, except
roots that a key translation failed to find.)

``outer_chain`` is the plain chained full outer join, for inputs that are unique per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.functions.sets import without


def source_rollup(df: DataFrame, prefix: str, root_col: str, count: str | None = None,
                  max_index: str | None = None, slot="slot", epoch="epoch",
                  network="meta_network_name", start="slot_start_date_time") -> DataFrame:
    """Per (slot, epoch, network, root): first slot start, and either the number of
    sightings (``count``) or max(index) + 1 (``max_index``).  Columns are prefixed."""
    aggs: list[Column] = [F.min(start).alias(f"{prefix}_start")]
    if count:
        aggs.append(F.count(F.lit(1)).alias(f"{prefix}_cnt"))
    if max_index:
        aggs.append((F.max(max_index) + 1).cast("bigint").alias(f"{prefix}_cnt"))
    return (df.groupBy(F.col(slot).cast("int").alias("slot"),
                       F.col(epoch).cast("int").alias("epoch"),
                       F.col(network).alias("network"),
                       F.col(root_col).alias(f"{prefix}_root"))
              .agg(*aggs))


def outer_chain(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """f1 FULL JOIN f2 USING (on) FULL JOIN f3 USING (on) ...; keys come out coalesced.
    Use on inputs that are unique per key (otherwise rows of a key are paired)."""
    return reduce(lambda a, b: a.join(b, list(on), "full"), frames)


def _tagged(frames: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    parts = []
    for i, (p, df) in enumerate(frames):
        cnt = F.col(f"{p}_cnt") if f"{p}_cnt" in df.columns else F.lit(None).cast("bigint")
        parts.append(df.select(*keys, F.lit(i).alias("_src"), F.col(f"{p}_start").alias("_start"),
                               F.col(f"{p}_root").alias("_root"), cnt.alias("_cnt")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def crossed_sightings(e: DataFrame, g: DataFrame, c: DataFrame, keys: Sequence[str],
                      start_alias: str = "slot_started_at") -> DataFrame:
    """Rollups e, g (with counts) and c (canonical) -> per (keys, start): canonical root
    (max), e roots, g roots (sets, NULL-free, canonical not removed), e / g max counts
    (0 when unseen) -- equal to regrouping their chained full outer join."""
    keys = list(keys)
    u = _tagged([("e", e), ("g", g), ("c", c)], keys).repartition(*keys)
    starts = u.groupBy(*keys, "_src", "_start").agg(
        F.collect_set("_root").alias("roots"), F.max("_cnt").alias("cnt"), F.max("_root").alias("top"))
    one = starts.groupBy(*keys).agg(
        F.min("_src").alias("_lead"), F.max(F.when(F.col("_src") == 1, F.col("cnt"))).alias("_g_cnt"),
        F.max(F.when(F.col("_src") == 2, F.col("top"))).alias("_c_top"),
        F.collect_list(F.struct("_src", F.col("_start").alias("start"), "roots", "cnt", "top")).alias("_parts"))
    ld = F.col("_lead")
    empty = F.array().cast("array<string>")
    # A root has one row per key and source, so the sets of a source's starts are disjoint.
    gossip = F.flatten(F.transform(F.filter("_parts", lambda p: p["_src"] == 1), lambda p: p["roots"]))
    out = one.select(*keys, "_lead", "_g_cnt", "_c_top", F.when(ld == 0, gossip).otherwise(empty).alias("_g_roots"),
                     F.explode(F.filter("_parts", lambda p: p["_src"] == ld)).alias("_part"))
    return out.select(
        *keys, F.col("_part.start").alias(start_alias),
        F.when(ld == 2, F.col("_part.top")).otherwise(F.col("_c_top")).alias("canonical"),
        F.when(ld == 0, F.col("_part.roots")).otherwise(empty).alias("e_roots"),
        F.when(ld == 1, F.col("_part.roots")).otherwise(F.col("_g_roots")).alias("g_roots"),
        F.when(ld == 0, F.col("_part.cnt")).otherwise(F.lit(0)).cast("bigint").alias("e_cnt"),
        F.when(ld == 0, F.coalesce(F.col("_g_cnt"), F.lit(0)))
         .when(ld == 1, F.col("_part.cnt")).otherwise(F.lit(0)).cast("bigint").alias("g_cnt"))


def precedence_rows(frames: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """Rollups in precedence order -> (keys, start, root, cnt) rows of the first source
    present for each key: equal to COALESCE(first, second, ...) over their chained full
    outer join rows."""
    keys = list(keys)
    u = _tagged(frames, keys)
    u = u.withColumn("_best", F.min("_src").over(Window.partitionBy(*keys)))
    return u.filter(F.col("_src") == F.col("_best")).select(
        *keys, F.col("_start").alias("start"), F.col("_root").alias("root"),
        F.col("_cnt").alias("cnt"))


def other_roots(arr_col: str, canonical_col: str) -> Column:
    """Sorted distinct roots of a set, minus NULLs and minus the canonical root."""
    return F.array_sort(without(F.col(arr_col), F.col(canonical_col)))
