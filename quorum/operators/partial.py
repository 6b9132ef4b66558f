"""Merge additive partial aggregate states (stored sums) on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_partial_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Stored ``sum`` states per key fragment -> one merged row per key."""
    return df.groupBy(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])
