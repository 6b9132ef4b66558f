import gzip
import hashlib
import io
import json
import zipfile

import pytest

from quorum.llm import warc_zip as wz

SCHEMA = "page_id long, url string, html string"


def rows():
    big, other = "<p>" + "same é " * 30, "x" * 100
    return [(5, "http://a/5", big), (3, "http://a/3", big), (9, "http://a/9", big), (1, "u", None), (2, "u", ""), (4, None, "small"),
            (6, "u", "small"), (7, "u\r\nEvil: 1", other), (8, "u", other + "y"), (None, "u", big), (None, "n", "z" * 200),
            (None, "n", "z" * 200), (11, "u", "x" * 99), (12, "u", "x" * 99), (13, "u", "long " * 400_000), (14, "u", "\r\n\r\nWARC/1.1"),
            (3, "again", big)]


def brute(data):
    first = {}
    for i, _, h in data:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in data:
        p = (h or "").encode()
        ref = first.get(p)
        again = ref is not None and ref != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", ref if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "1 as page", "2 as kind", "3 as digest").repartition(3)
    got = wz.archived_pages(spark, df, str(tmp_path / "a")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows())
    archives = wz.write_archives(df, str(tmp_path / "b"))
    full = {r.record_id: r for r in wz.read_archives(archives).filter("type = 'response'").collect()}
    assert bytes(full["urn:page:14"].payload) == b"\r\n\r\nWARC/1.1" and full["urn:page:7"].uri == "u%0D%0AEvil: 1"
    listed = wz.list_members(archives).collect()
    assert {m.method for m in listed} == {0} and any(m.member == "indexes/index.cdxj" for m in listed)


def test_empty_table(spark, tmp_path):
    assert wz.archived_pages(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "e")).collect() == []


class Held(wz.Ranges):
    def __init__(self, data):
        import pyarrow as pa
        self.file = pa.BufferReader(data)
        self.size = len(data)


def packed(comment=b"", force64=False, prefix=b"", many=3, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for i in range(many):
            with z.open(f"mémber-{i}", "w", force_zip64=force64) as f:
                f.write(f"content {i}".encode() * 10)
        z.comment = comment
    return prefix + out.getvalue()


@pytest.mark.parametrize("kwargs", [{}, {"comment": b"PK\x05\x06" + b"c" * 60_000}, {"force64": True}, {"prefix": b"#!/bin/sh\n" * 9},
                                    {"many": 0}, {"many": 66_000}])
def test_directories(kwargs):
    data = packed(**kwargs)
    found = wz.members(Held(data))
    assert [m["member"] for m in found] == [f"mémber-{i}" for i in range(kwargs.get("many", 3))]
    for i, m in enumerate(found[:50]):
        assert Held(data).read(m["offset"], m["size"]) == f"content {i}".encode() * 10


def test_zip64_fields():
    """Offsets and sizes that only the ZIP64 extra field holds."""
    import struct
    body = b"stored bytes"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + b"m" + \
        struct.pack("<HHQQ", 1, 16, len(body), len(body))
    at = 7
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), at)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0,
                          0xFFFFFFFF) + b"m" + extra
    head = b"\0" * at + local + body
    record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), len(head))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(head) + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = head + central + record + locator + end
    found = wz.members(Held(data))[0]
    assert Held(data).read(found["offset"], found["size"]) == body


def test_broken_files_are_errors(spark, tmp_path):
    for data in (b"", b"PK", b"no zip" * 100, packed()[:-30]):
        with pytest.raises(ValueError):
            wz.members(Held(data))
    with pytest.raises(ValueError):
        wz.parsed(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort")
    with pytest.raises(ValueError):
        Held(b"abc").read(2, 5)


def test_deflated_index_and_foreign_archive(spark, tmp_path):
    """An archive of another writer: plain records, a compressed index."""
    raw = wz.record("response", "urn:page:1", "http://x", b"payload", "d", None)
    second = gzip.compress(wz.record("response", "urn:page:2", "http://y", b"more", "d", None))
    with zipfile.ZipFile(tmp_path / "f.wacz", "w") as z:
        z.writestr(zipfile.ZipInfo("archive/a.warc"), raw + second)
        lines = [{"filename": "a.warc", "offset": "0", "length": str(len(raw))}, {"filename": "a.warc", "offset": len(raw), "length": len(second)}]
        z.writestr("indexes/index.cdx.gz", gzip.compress("".join(f"key 2020 {json.dumps(x)}\n" for x in lines).encode()), zipfile.ZIP_DEFLATED)
    got = wz.read_archives(spark.createDataFrame([(str(tmp_path / "f.wacz"),)], "path string")).collect()
    assert {r.record_id: bytes(r.payload) for r in got} == {"urn:page:1": b"payload", "urn:page:2": b"more"}
