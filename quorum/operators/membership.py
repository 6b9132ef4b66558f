"""Expected members (exploded from member lists) and the ones never seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_members(df: DataFrame, keys: Sequence[str], members: str,
                    member_alias: str = "validator_index", distinct: bool = False) -> DataFrame:
    """One row per list element (an empty list yields no row)."""
    out = df.select(*keys, F.explode(members).alias(member_alias))
    return out.distinct() if distinct else out


def missing_members(expected: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct expected rows without a seen row on ``on``; a NULL in ``on`` never matches.

    Written as one tagged union and one aggregation: repeated expected rows and repeated
    sightings shrink in the map-side partial, and there is one shuffle in all.  The other
    columns of ``expected`` must be fixed by ``on`` (a slot's start time is)."""
    on = list(on)
    rest = [c for c in expected.columns if c not in on]
    never_null = F.lit(True)
    for c in on:
        never_null = never_null & F.col(c).isNotNull()
    tagged = expected.withColumns({"_expected": F.lit(True), "_seen": F.lit(False)}).unionByName(
        seen.select(*on).filter(never_null).withColumns({"_expected": F.lit(False), "_seen": F.lit(True)}),
        allowMissingColumns=True)
    return (tagged.groupBy(*on)
            .agg(*[F.max(c).alias(c) for c in rest], F.max("_expected").alias("_expected"),
                 F.max("_seen").alias("_seen"))
            .filter(F.col("_expected") & ~F.col("_seen")).select(*expected.columns))
