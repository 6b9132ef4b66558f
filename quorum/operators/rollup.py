"""Grouped rollups, distinct rows and unions of hash sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def rollup(df: DataFrame, keys: Sequence, aggs: Sequence[Column]) -> DataFrame:
    """GROUP BY many keys with aggregates (partial aggregation happens map-side)."""
    return df.groupBy(*keys).agg(*aggs)


def distinct_rows(df: DataFrame, cols: Sequence) -> DataFrame:
    """GROUP BY without aggregates = the distinct projected rows."""
    return df.select(*cols).distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """UNION ALL of projections, then distinct (one shuffle on the projected columns)."""
    return union_all([f.select(*cols) for f in frames]).distinct()
