"""Nearest-key join (as-of in both directions), without pairing rows.

For every left row, find the right row with equal keys whose position (e.g. a slot) is
closest; ties go to the earlier right position.  Unmatched left rows keep NULL values.

The obvious plan -- join on the keys, then take the argmin of the distance -- emits every
(left, right) pair of a key and explodes on hot keys.  This plan never pairs rows:

1. The position axis is cut into ranges of ``range_width``.  Left and right rows are
   unioned and sorted inside each (keys, range) partition; two running aggregates over
   the one sort give, per left row, the last right entry at or before it and the first
   right entry after it *within the range*.  A key holding a third of all rows is
   spread over all of its ranges, so no task sees a whole hot key.
2. A summary with one row per (keys, range) that holds right rows (its min and max entry)
   or left rows gives, by a second small ordered window per key, the nearest right entry
   in an *earlier* and in a *later* range.  Its size per key is the number of occupied
   ranges, bounded by the position span / ``range_width``, not by the row count.
3. An equi-join on (keys, range) attaches the summary; the nearer of the candidates wins.

Left rows that repeat a (keys, position) are collapsed before step 1 and the answers are
joined back on (keys, position): a hot left position then only weighs on an equi-join,
whose skewed partitions AQE splits.  Callers whose left side is already distinct per
(keys, position) pass ``left_unique=True`` and skip that round trip.

Right rows should be unique per (keys, position) (the callers read latest versions by
exactly that key); if not, equal positions are broken by the value columns so that the
result stays deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pairs(on) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def nearest_join(left: DataFrame, right: DataFrame, on: Sequence, left_pos: str, right_pos: str,
                 values: Sequence[str], range_width: int = 64,
                 distance_col: str | None = "distance", matched_pos_col: str | None = None,
                 left_unique: bool = False) -> DataFrame:
    """Left rows + the ``values`` of the nearest right row (+ |distance|, matched position)."""
    if range_width < 1:
        raise ValueError("range_width must be >= 1")
    pairs = _pairs(on)
    if not left_unique:
        lkeys = [lk for lk, _ in pairs] + [left_pos]
        if len(set(lkeys)) != len(lkeys):
            raise ValueError("left key and position columns must be distinct")
        probes = left.select(*[F.col(f"`{c}`") for c in lkeys]).distinct()
        answers = nearest_join(probes, right, on, left_pos, right_pos, values, range_width,
                               distance_col, matched_pos_col, left_unique=True)
        extra = [c for c in answers.columns if c not in lkeys]
        return left.join(answers, lkeys, "left").select(*left.columns, *extra)
    keys = [f"_k{i}" for i in range(len(pairs))]
    values = list(values)

    lcols = left.columns
    # Every row travels as (keys, range, left row or NULL, right entry or NULL).  Both uses
    # below read all four, so Spark runs the two sides and their exchange once.
    # A left row with a NULL key or position matches nothing: it travels under NULL keys,
    # spread over ranges of its own.
    usable = F.col(f"`{left_pos}`").isNotNull()
    for lk, _ in pairs:
        usable = usable & F.col(f"`{lk}`").isNotNull()
    at = F.col(f"`{left_pos}`").cast("bigint")
    row = F.struct(at.alias("p"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(lcols)])
    l = left.select(*[F.when(usable, F.col(f"`{lk}`")).alias(k) for (lk, _), k in zip(pairs, keys)],
                    F.when(usable, F.floor(at / F.lit(range_width)).cast("bigint"))
                     .otherwise(F.pmod(F.xxhash64(row), F.lit(1024))).alias("_rng"),
                    row.alias("_left"))
    matchable = F.col(f"`{right_pos}`").isNotNull()
    for _, rk in pairs:
        matchable = matchable & F.col(f"`{rk}`").isNotNull()
    at = F.col(f"`{right_pos}`").cast("bigint")
    r = right.filter(matchable).select(
        *[F.col(f"`{rk}`").alias(k) for (_, rk), k in zip(pairs, keys)],
        F.floor(at / F.lit(range_width)).cast("bigint").alias("_rng"),
        F.struct(at.alias("p"), *[F.col(f"`{v}`").alias(f"x{i}") for i, v in enumerate(values)]).alias("_entry"))
    both = (l.withColumn("_entry", F.lit(None).cast(r.schema["_entry"].dataType))
            .unionByName(r, allowMissingColumns=True)
            .filter(F.col("_rng").isNotNull())
            .repartition(*keys, "_rng"))
    pos = F.coalesce(F.col("_left.p"), F.col("_entry.p"))
    is_left = F.col("_left").isNotNull()

    # 1. inside each (keys, range): running last-before / first-after over one sort
    w = Window.partitionBy(*keys, "_rng").orderBy(pos, is_left, "_entry")
    within = (both
              .withColumn("_before", F.last("_entry", ignorenulls=True)
                          .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("_after", F.first("_entry", ignorenulls=True)
                          .over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .filter(is_left).select(*keys, "_rng", "_left", "_before", "_after"))

    # 2. per (keys, range) summary -> nearest entries in earlier / later ranges, from the
    #    same exchange
    summary = (both.groupBy(*keys, "_rng")
               .agg(F.max("_entry").alias("_hi"), F.min("_entry").alias("_lo"),
                    F.max(is_left).alias("_need")))
    ws = Window.partitionBy(*keys).orderBy("_rng")
    summary = (summary
               .withColumn("_prev", F.last("_hi", ignorenulls=True)
                           .over(ws.rowsBetween(Window.unboundedPreceding, -1)))
               .withColumn("_next", F.first("_lo", ignorenulls=True)
                           .over(ws.rowsBetween(1, Window.unboundedFollowing)))
               .filter(F.col("_need"))
               .select(*[F.col(k).alias(f"{k}s") for k in keys], F.col("_rng").alias("_rngs"), "_prev", "_next"))

    # 3. attach (NULL keys meet themselves, so no filter sets the two uses apart) and choose
    same = F.col("_rng") == F.col("_rngs")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}s"))
    joined = within.join(summary, same, "left").withColumn("_pos", F.col("_left.p"))
    before = F.coalesce(F.col("_before"), F.col("_prev"))
    after = F.coalesce(F.col("_after"), F.col("_next"))
    d_before = F.col("_pos") - before["p"]
    d_after = after["p"] - F.col("_pos")
    best = F.when(after.isNull() | (before.isNotNull() & (d_before <= d_after)), before).otherwise(after)
    out = joined.select("_left", "_pos", best.alias("_best"))
    extra = [F.col("_best")[f"x{i}"].alias(v) for i, v in enumerate(values)]
    if distance_col:
        extra.append(F.abs(F.col("_best.p") - F.col("_pos")).alias(distance_col))
    if matched_pos_col:
        extra.append(F.col("_best.p").alias(matched_pos_col))
    return out.select(*[F.col(f"_left.c{i}").alias(c) for i, c in enumerate(lcols)], *extra)
