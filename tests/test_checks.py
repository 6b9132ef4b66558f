"""Format rules of the declared sources are counted, never enforced by padding."""

from quorum.sources.catalog import conform
from quorum.sources.checks import violations


def test_violations_are_counted(spark):
    good = "0x" + "a" * 64
    df = spark.createDataFrame(
        [(good, "0x" + "b" * 40, "0x12345678", 5),
         ("0x" + "A" * 64, "0x" + "b" * 39, "0x1234", -1),     # upper-case hex, short, negative
         (good[:-1], None, None, None)],
        "hash string, fromaddress string, data4bytes string, value long")
    df = conform(df, "block_native_mempool_transaction")
    got = {(r.column, r.rule): (r.checked, r.violations)
           for r in violations(df, "block_native_mempool_transaction").collect()}
    assert got[("hash", "hash_hex_64")] == (3, 2)
    assert got[("fromaddress", "address_hex_40")] == (3, 1)
    assert got[("data4bytes", "selector_hex_8")] == (3, 1)
    assert got[("value", "uint128_range")] == (3, 1)


def test_numbers_beyond_128_bits_are_counted_not_fatal(spark):
    from quorum.sources.catalog import conform
    df = spark.createDataFrame([("0x" + "a" * 64, str(2 ** 128 - 1)), ("0x" + "b" * 64, "-1"), ("0x" + "c" * 64, "7"),
                                ("0x" + "d" * 64, None)], "hash string, value string")
    found = {(r.column, r.rule): r.violations for r in violations(df, "mempool_transaction").collect()}
    assert found["value", "uint128_range"] == 2
    assert [r.value for r in conform(df, "mempool_transaction").orderBy("hash").collect()][2:] == [7, None]
    assert conform(df, "mempool_transaction").filter("value is null").count() == 2
