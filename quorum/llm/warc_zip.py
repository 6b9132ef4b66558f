"""WARC records in ZIP-packaged archives, read by ranges without extraction.

Writing: each task streams its pages into one ZIP file of stored members
(``archive/data-N.warc.gz`` with one gzip member per record, and ``indexes/index.cdxj``),
under a name of its own; only the names that finished tasks return are read, so a lost or
repeated task leaves no trace in the result.

Reading: the end of a file gives its central directory (ZIP64 forms included), the directory
gives the stored members, the index member gives the records' ranges; ranges of neighbouring
records are dealt over tasks, which read just these bytes.

Files are opened through the file system that their address names, so any store that Arrow
knows serves; the folder is the session's shared checkpoint folder unless one is given.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.llm.common import binaries, cut
from quorum.session import scratch_path

MEMBER_BYTES = 64 << 20     # a WARC member is closed beyond this size
RANGE_BYTES = 4 << 20       # neighbouring records read at once
REVISIT_BYTES = 100         # smaller payloads are never revisits
STORED = 0
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str):
    filesystem, inner = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return filesystem, inner


# --- ZIP directories -------------------------------------------------------------------

class Ranges:
    """Reads byte ranges of one file."""

    def __init__(self, path: str) -> None:
        filesystem, inner = _open(path)
        self.file = filesystem.open_input_file(inner)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"range {offset}+{length} lies outside a file of {self.size} bytes")
        return self.file.read_at(length, offset)

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def members(source: Ranges) -> list[dict]:
    """Members of a ZIP file: name, method, offset of the stored bytes, size.

    The central directory is found from the file's end, behind a comment of any length, and
    through the ZIP64 locator where the plain fields are exhausted; bytes before the archive
    (a self-extractor's) shift all offsets.
    """
    tail_at = max(0, source.size - 65557)
    tail = source.read(tail_at, source.size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("not a ZIP file: no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= 20 and source.read(end - 20, 4) == b"PK\x06\x07":
        where = struct.unpack("<Q", source.read(end - 12, 8))[0]
        if where + 56 > end or source.read(where, 4) != b"PK\x06\x06":
            # Displaced by bytes before the archive: it ends right before its locator.
            where = end - 20 - 56
        record = source.read(where, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("broken ZIP64 end of central directory")
        count, size, offset = struct.unpack_from("<QQQ", record, 32)
        end = where
    shift = end - size - offset
    directory = source.read(offset + shift, size)
    out, at = [], 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = directory[at + 46 + n:at + 46 + n + m], 0
        while e + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, e)
            if kind == 1:       # ZIP64: only the exhausted fields, in this order
                wide = [struct.unpack_from("<Q", extra, e + 4 + 8 * i)[0] for i in range(length // 8)]
                if plain == 0xFFFFFFFF:
                    plain = wide.pop(0)
                if packed == 0xFFFFFFFF:
                    packed = wide.pop(0)
                if local == 0xFFFFFFFF:
                    local = wide.pop(0)
            e += 4 + length
        header = source.read(local + shift, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"broken local header of {name}")
        skip = 30 + sum(struct.unpack_from("<HH", header, 26))
        out.append({"member": name, "method": method, "encrypted": bool(flags & 1), "offset": local + shift + skip,
                    "size": packed, "plain_size": plain})
        at += 46 + n + m + k
    return out


# --- WARC records ----------------------------------------------------------------------

def _safe(value: str) -> str:
    """A header value without line breaks, which would start another header."""
    return re.sub(r"[\r\n\0]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", _safe(uri)),
               ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", _PROFILE)]
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record; the payload is what follows the HTTP headers."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("truncated WARC record")
    block = rest[:length]
    if headers.get("content-type", "").startswith("application/http"):
        return headers, block.partition(b"\r\n\r\n")[2]
    return headers, block


def _writer(folder: str):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{uuid.uuid4().hex}.wacz"
        filesystem, inner = _open(path)
        written, index, archive, out, member, name, offset = 0, [], None, None, None, "", 0
        for batch in rows:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            for page, uri, kind, refers, digest, payload in zip(*columns, binaries(batch.column(2)), strict=True):
                payload = payload or b""
                if archive is None:
                    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out = filesystem.open_output_stream(inner)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                if member is None or offset >= MEMBER_BYTES:
                    if member is not None:
                        member.close()
                    name, offset = f"archive/data-{len(archive.namelist()):05d}.warc.gz", 0
                    member = archive.open(name, "w", force_zip64=True)
                own = f"urn:page:{'null' if page is None else page}"
                packed = gzip.compress(record(kind, own, uri or "", payload, digest,
                                              None if refers is None else f"urn:page:{refers}"), 3, mtime=0)
                member.write(packed)
                index.append(json.dumps({"url": uri, "filename": name, "offset": offset, "length": len(packed)}))
                offset += len(packed)
                written += 1
        if archive is not None:
            member.close()
            archive.writestr("indexes/index.cdxj", "".join(f"{x}\n" for x in index))
            archive.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([written], pa.int64())], names=["path", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; returns ``(path, records)`` of the archives.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes, those with the least id
    are responses and the others revisits of it, without a payload.  A null payload is
    empty; a null id counts as larger than any other, and rows of null ids alone are all
    responses.  Line breaks in a url are written as %0D and %0A.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("uri"),
                        F.col(html_col).cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = base.select("page", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")) \
        .filter(F.col("n") >= REVISIT_BYTES)
    groups = digests.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("copies")) \
        .filter("copies > 1 and first is not null")
    revisits = cut(groups, "revisits").select(F.col("digest").alias("seen"), "first")
    rows = base.withColumn("digest", F.sha2(payload, 256)).join(revisits, F.col("digest") == F.col("seen"), "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    rows = rows.select("page", "uri", "html", F.when(again, "revisit").otherwise("response").alias("kind"),
                       F.when(again, F.col("first")).alias("refers"), "digest")
    return cut(rows.mapInArrow(_writer(folder), "path string, records long"), "archives")


def list_members(archives: DataFrame) -> DataFrame:
    """``(path, member, method, encrypted, offset, size, plain_size)`` of each archive's members."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path in batch.column(0).to_pylist():
                with Ranges(path) as source:
                    found = [{"path": path, **m} for m in members(source)]
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema(
                        [("path", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("encrypted", pa.bool_()),
                         ("offset", pa.int64()), ("size", pa.int64()), ("plain_size", pa.int64())]))

    return archives.select("path").filter("path is not null").mapInArrow(
        run, "path string, member string, method int, encrypted boolean, offset long, size long, plain_size long")


def _indexed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record ranges of each archive's index members, neighbours packed to one range."""
    for batch in rows:
        for path in batch.column(0).to_pylist():
            with Ranges(path) as source:
                found = {m["member"]: m for m in members(source)}
                spans = []
                for name, m in found.items():
                    if not re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", name) or m["method"] not in (STORED, 8):
                        continue
                    raw = source.read(m["offset"], m["size"])
                    raw = raw if m["method"] == STORED else zlib.decompress(raw, -15)
                    raw = gzip.decompress(raw) if name.endswith(".gz") else raw
                    for line in raw.decode("utf-8").splitlines():
                        entry = json.loads(line[line.index("{"):])
                        at = found.get(entry["filename"]) or found.get(f"archive/{entry['filename']}")
                        if at is None or at["method"] != STORED or at["encrypted"]:
                            raise ValueError(f"{entry['filename']} in {path} is not a stored member")
                        spans.append((at["offset"] + int(entry["offset"]), int(entry["length"])))
            spans.sort()
            out: list[dict] = []
            for offset, length in spans:
                last = out[-1] if out else None
                if last and offset == last["offset"] + sum(last["lengths"]) and sum(last["lengths"]) < RANGE_BYTES:
                    last["lengths"].append(length)
                else:
                    out.append({"path": path, "offset": offset, "lengths": [length]})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema(
                    [("path", pa.string()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))]))


def _records(keep_payload: bool):
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()),
                        ("uri", pa.string()), ("refers_to", pa.string()), ("declared_digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for r in batch.to_pylist():
                with Ranges(r["path"]) as source:
                    raw = source.read(r["offset"], sum(r["lengths"]))
                out, at = [], 0
                for length in r["lengths"]:
                    data = raw[at:at + length]
                    headers, payload = parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
                    response = headers["warc-type"] == "response"
                    out.append({
                        "path": r["path"], "offset": r["offset"] + at, "type": headers["warc-type"],
                        "record_id": headers["warc-record-id"].strip("<>"), "uri": headers.get("warc-target-uri"),
                        "refers_to": headers.get("warc-refers-to", "").strip("<>") or None,
                        "declared_digest": headers.get("warc-payload-digest", "").partition(":")[2] or None,
                        "payload_bytes": len(payload) if response else None,
                        "payload_digest": hashlib.sha256(payload).hexdigest() if response else None,
                        "payload": payload if keep_payload and response else None})
                    at += length
                yield pa.RecordBatch.from_pylist(out, schema)
    return run


def read_archives(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of archives ``(path)``, by range reads along their indexes.

    ``(path, offset, type, record_id, uri, refers_to, declared_digest, payload_bytes,
    payload_digest, payload)``; the payload columns are null for revisits.  An archive
    without an index has no record to locate; a record outside a stored member, a broken
    directory or a truncated record is an error.
    """
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = archives.select("path").filter("path is not null").repartition(n) \
        .mapInArrow(_indexed, "path string, offset long, lengths array<long>")
    return ranges.repartition(n).mapInArrow(
        _records(keep_payload), "path string, offset long, type string, record_id string, uri string, refers_to string, "
        "declared_digest string, payload_bytes long, payload_digest string, payload binary")


def archived_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages' archives, read them back, one row per page.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``; a revisit takes the
    length from the response it refers to and must agree with its digest.
    """
    folder = folder or scratch_path(spark, "archives-of-pages")
    found = cut(read_archives(write_archives(pages, folder), keep_payload=False), "records")
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")  # noqa: E731 - after "urn:page:"
    rows = found.select(number("record_id").alias("page_id"), "type", number("refers_to").alias("refers_to"),
                        "payload_bytes", "payload_digest", "declared_digest")
    responses = rows.filter("type = 'response'")
    targets = responses.select(F.col("page_id").alias("target"), F.col("payload_bytes").alias("n"),
                               F.col("payload_digest").alias("digest")).distinct()
    revisits = rows.filter("type = 'revisit'").join(
        targets, (F.col("refers_to") == F.col("target")) & (F.col("declared_digest") == F.col("digest")), "left")
    return responses.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to")) \
        .union(revisits.select("page_id", F.col("n"), F.col("digest"), "type", "refers_to"))
