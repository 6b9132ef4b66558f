"""Where jobs read their sources from."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from quorum.sources.catalog import conform, source
from quorum.sources.scan import DAY


class Sources(Protocol):
    def get(self, name: str) -> DataFrame: ...


class ParquetSources:
    """Sources stored as Parquet datasets ``<root>/<source name>/`` (declared schemas).

    Their stored types are checked once per source: a declared column that is missing or has
    another type is an error, not a NULL column.  A dataset written by ``write_source`` is
    partitioned by ``day``; the jobs' windowed scans then prune day folders as well as row
    groups.  Files that cannot be split are a matter of how they are written (row groups of
    ``parquet.block.size``, ``spark.sql.files.maxPartitionBytes``), not of the jobs' plans."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def _checked(self, name: str) -> StructType:
        stored = {f.name: f.dataType for f in self.spark.read.parquet(f"{self.root}/{name}").schema.fields}
        declared = source(name).schema
        wrong = [f"{f.name} {stored[f.name].simpleString()} (declared {f.dataType.simpleString()})"
                 for f in declared.fields if f.name in stored and stored[f.name] != f.dataType]
        if wrong:
            raise ValueError(f"{name}: stored types differ: {', '.join(wrong)}")
        missing = [f for f in (source(name).time_col, *source(name).key, *source(name).version) if f and f not in stored]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        day = [StructField(DAY, DateType())] if DAY in stored else []
        return StructType(declared.fields + day)

    def get(self, name: str) -> DataFrame:
        if name not in self._schemas:
            self._schemas[name] = self._checked(name)
        return self.spark.read.schema(self._schemas[name]).parquet(f"{self.root}/{name}")


def write_source(df: DataFrame, root: str, name: str, mode: str = "append") -> None:
    """Store a source as ``<root>/<name>/day=YYYY-MM-DD/``, by ranges of day and time: days
    prune folders, row groups skip inside a day, and a large day is several tasks' files."""
    t = source(name).time_col
    out = conform(df, name).withColumn(DAY, F.to_date(t))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(n, DAY, t).sortWithinPartitions(DAY, t).write.mode(mode).partitionBy(DAY)
        .parquet(f"{root.rstrip('/')}/{name}"))


class BucketedSources:
    """Sources stored once as catalog tables bucketed and sorted by a key (``write_bucketed``).

    Aggregates and joins by columns that start with the key read the buckets as they lie, without
    a shuffle.  A bucket is one task: the layout is for keys none of which holds a large share of
    the rows (a slot's reports are bounded by the fleet); others belong in ``ParquetSources``,
    whose shuffles spread a hot key by map-side partials."""

    def __init__(self, spark: SparkSession, tables: dict[str, str]):
        self.spark, self.tables = spark, dict(tables)

    def get(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])


def write_bucketed(df: DataFrame, name: str, table: str, path: str, key: Sequence[str], buckets: int) -> str:
    """Store a source as the external table ``table`` under ``path``, bucketed by ``key``; dealt by
    the key first, so that a bucket is one file instead of one per writing task."""
    (conform(df, name).repartition(buckets, *key).write.format("parquet").option("path", path)
        .bucketBy(buckets, *key).sortBy(*key).saveAsTable(table))
    return table


class FrameSources:
    """Sources given as DataFrames (tests, notebooks); checked against the catalog."""

    def __init__(self, frames: dict[str, DataFrame]):
        from quorum.sources.catalog import conform
        self.frames = {name: conform(df, name, fill=True) for name, df in frames.items()}

    def get(self, name: str) -> DataFrame:
        return self.frames[name]
