"""What a task holds and what is sent must not outgrow the input."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from quorum.functions.keys import packed_hex, unpacked_hex
from quorum.plans import models as M
from quorum.plans import queries
from quorum.sources.adapters import Fixture
from quorum.sources.scan import RunWindow
from tests.conftest import SMALL


@pytest.mark.parametrize("name", ["canonical_beacon_block_execution_transaction", "mempool_transaction",
                                  "block_native_mempool_transaction", "mempool_dumpster_transaction"])
def test_transaction_attributes_are_derived_in_all_partitions(spark, name):
    """However few bytes the dealt rows are, their partitions are not merged."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert Fixture(spark, SMALL).get(name).select("hash").rdd.getNumPartitions() in (n, 2 * n)


def test_packed_hex_gives_every_text_back(spark):
    texts = ["0x", "0xab", "0xAB", "0xabc", "ab", "", "0xzz", "0x00ff", "x0ab", "0X00", "é", "0xab ", None, "0x" + "0f" * 32]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed_hex("t"))
    assert all(r.t == r.u for r in df.select("t", unpacked_hex("p").alias("u")).collect())
    assert df.select("p").distinct().count() == len(texts)
    assert df.filter(F.col("t") == "0x" + "0f" * 32).select(F.length("p")).first()[0] == 33


def test_hashes_are_shuffled_packed(spark):
    out = M.transaction_hashes(Fixture(spark, SMALL), RunWindow.backfill(), "2024-02-01 00:00:00")
    assert out.schema["hash"].dataType.simpleString() == "string"
    assert dict(M.packed_hashes(Fixture(spark, SMALL), None).dtypes)["hash"] == "binary"


def test_streamed_sources_are_as_many_files_as_partitions(spark, monkeypatch):
    """No task writes or reads half of a source."""
    roots = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name, f=queries.scratch_path: roots.append(f(s, name)) or roots[-1])
    n, out = int(spark.conf.get("spark.sql.shuffle.partitions")), queries.stream_hash_universe(spark, SMALL)
    assert out.count() == M.transaction_hashes(Fixture(spark, SMALL), RunWindow.backfill(), "2024-02-01 00:00:00").count()
    for name in ("mempool_transaction", "block_native_mempool_transaction", "mempool_dumpster_transaction"):
        assert len(glob.glob(os.path.join(roots[0], name, "part-*"))) == 2 * n
    rows = spark.range(10_000)
    queries._deliver(rows, path := os.path.join(roots[0], "delivered"), 2)
    assert len(glob.glob(os.path.join(path, "part-*"))) == 2 * n
    batches = []
    queries._streamed(spark, rows.schema, path).writeStream.foreachBatch(lambda df, i: batches.append(df.count())) \
        .option("checkpointLocation", os.path.join(roots[0], "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == 2 and sum(batches) == 10_000
