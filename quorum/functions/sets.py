"""Distinct-set aggregates and their canonical rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distinct_set(c) -> Column:
    """Distinct values of a group (NULL skipped, '' kept), sorted so results are stable."""
    return F.array_sort(F.collect_set(_c(c)))


def merged_set(c) -> Column:
    """The union of a group's sets, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(_c(c)))))


def without(arr, excluded) -> Column:
    """Drop NULLs and one excluded value (NULL excluded value drops only NULLs)."""
    arr, excluded = _c(arr), _c(excluded)
    return F.filter(arr, lambda x: x.isNotNull() & (excluded.isNull() | (x != excluded)))


def set_string(arr) -> Column:
    """Render an array as its sorted distinct elements joined by ',' ('' when empty)."""
    return F.array_join(F.array_sort(F.array_distinct(_c(arr).cast("array<string>"))), ",")
