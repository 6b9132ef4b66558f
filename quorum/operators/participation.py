"""M4 core, A5 / A7 / A12 / J3 / F8 / F12: distinct members seen / members expected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expected_size(committees: DataFrame, keys: Sequence[str], committee: str,
                  members: str) -> DataFrame:
    """Sum over committees of the largest reported committee size (sentries repeat rows)."""
    keys = list(keys)
    per_committee = (committees.groupBy(*keys, committee)
                     .agg(F.max(F.size(members)).alias("_size")))
    return per_committee.groupBy(*keys).agg(F.sum("_size").cast("bigint").alias("total_validators"))


def seen_count(reports: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Exact COUNT(DISTINCT member) per keys (NULL members ignored)."""
    return reports.groupBy(*keys).agg(F.countDistinct(member).alias("attesting_validators"))


def participation(reports: DataFrame, committees: DataFrame, keys: Sequence[str], member: str,
                  committee: str, members: str, strategy: str | None = None) -> DataFrame:
    """Inner join of seen and expected on ``keys``; rate = seen / expected as double
    (NULL when nothing is expected, where the source system yields inf / nan).
    ``strategy`` is a join hint; "merge" keeps the partitioning of bucketed inputs."""
    keys = list(keys)
    seen = seen_count(reports, keys, member)
    total = expected_size(committees, keys, committee, members)
    out = seen.join(total.hint(strategy) if strategy else total, keys, "inner")
    rate = F.try_divide(F.col("attesting_validators").cast("double"),
                        F.col("total_validators").cast("double"))
    return out.withColumn("participation_rate", rate)
