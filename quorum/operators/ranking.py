"""The first row of every group under an ordering.

ROW_NUMBER() OVER (PARTITION BY g ORDER BY o) = 1 is computed as ``min(struct(o..., kept
columns...))`` grouped by g: a sort aggregate with a map-side partial, so each map task
ships one row per group, and a hot group never lands whole in one task.  NULL order values
sort last.  The kept columns double as a deterministic tie-break (the source system leaves
ties arbitrary).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str],
                    keep: Sequence[str]) -> DataFrame:
    """Per ``group`` the row with the least (``order``, ``keep``) in ascending order."""
    group = list(group)
    fields = []
    for c in list(order) + list(keep):
        if c not in group and c not in fields:
            fields.append(c)
    # a NULL sorts first inside a struct: a flag before each order value puts it last
    packed = F.struct(*[x for i, c in enumerate(fields) for x in
                        ([F.col(c).isNull().alias(f"n{i}")] if c in order else []) + [F.col(c).alias(f"f{i}")]])
    out = df.groupBy(*group).agg(F.min(packed).alias("_first"))
    return out.select(*group, *[F.col(f"_first.f{i}").alias(c) for i, c in enumerate(fields)])


def first_per_group_ranked(df: DataFrame, group: Sequence[str], order: Sequence[str],
                           keep: Sequence[str]) -> DataFrame:
    """The same result written as ROW_NUMBER() OVER (PARTITION BY group ORDER BY order,
    keep) = 1.  Catalyst plans it with a partial WindowGroupLimit before the shuffle."""
    group = list(group)
    fields = []
    for c in list(order) + list(keep):
        if c not in group and c not in fields:
            fields.append(c)
    w = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_last() if c in order else F.col(c).asc_nulls_first()
                                              for c in fields])
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
              .select(*group, *fields))
