"""WARC records in ZIP packages, read back by ranges.

A package is a ZIP archive with three stored (not compressed) members: ``archive/data.warc.gz`` with one gzip member for each
record, ``indexes/index.cdxj`` with the place and size of each record there, and ``datapackage.json``. As members are stored, a
record is a range of bytes of the package itself: a reader takes the end of the file, the central directory, the local header of
a member, the index and then the records that it wants, and never unpacks an archive. ZIP64 directories and sizes are read
(and written, where sizes ask for it or ``zip64`` does).

Of pages with equal payloads of ``REVISIT_BYTES`` or more, the one with the largest id is stored; the others are
revisit records that name it and hold HTTP headers only. Only ids, digests and sizes are shuffled to find them.

Packages are written by the tasks that read the pages, each under a new name that is reported in a written manifest;
what a failed or repeated attempt left is in no manifest and is never read. Reading plans ranges of neighbouring records first,
so that a large package is read by many tasks.

Defined results: a null html is an empty payload; a null url gives no target URI; equal payloads mean equal SHA-256 and size; a
null id counts as the smallest; rows that repeat the largest id of a payload are all stored; an empty table gives an empty
manifest and no records; other columns are ignored. A page of any size is one record, held whole by one task.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import cut, read_shared, shared_file, tidy, write_shared
from addrweave.session import scratch_path

REVISIT_BYTES = 1000  # shorter payloads are always stored
PACKAGE_BYTES = 64 << 20  # compressed records after which a task begins a new package
RANGE_BYTES = 4 << 20  # neighbouring records read at once
BROADCAST_ROWS = 100_000  # repeated payloads (about 100 bytes each) that are sent to all tasks
SALTS = 32  # tasks that share the pages of one payload
LEVEL = 3  # gzip level
DATA, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures, and the marker of a field that stands in the ZIP64 extra field.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
EXTRA64, IN64, IN64_COUNT = 0x0001, 0xFFFFFFFF, 0xFFFF


# ------------------------------------------------------------------ ZIP directories


class NotAPackage(ValueError):
    pass


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    crc: int
    packed: int
    size: int
    header: int  # place of the local header


def file_size(path: str) -> int:
    system, at = shared_file(path)
    return system.get_file_info(at).size


def _bytes(path: str, start: int, size: int) -> bytes:
    return read_shared(path, start, size).tobytes()


def _directory(path: str) -> tuple[int, int, int, int]:
    """(place, size, entries of the central directory, bytes that stand before the archive)."""
    whole = file_size(path)
    tail_at = max(0, whole - 22 - 0xFFFF)  # the end record may be followed by a comment
    tail = _bytes(path, tail_at, whole - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(END, 0, at)
        if at < 0:
            raise NotAPackage(f"{path}: no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    disk, first_disk, here, entries, size, place = struct.unpack_from("<HHHHII", tail, at + 4)
    end = tail_at + at  # where the directory ends, if no ZIP64 record stands between
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        where = struct.unpack_from("<Q", tail, at - 12)[0]
        found = next((w for w in (where, end - 20 - 56) if 0 <= w <= whole - 56 and _bytes(path, w, 4) == END64), None)
        if found is None:
            raise NotAPackage(f"{path}: no ZIP64 end record where its locator says")
        disk, first_disk, here, entries, size, place = struct.unpack_from("<IIQQQQ", _bytes(path, found, 56), 16)
        end = found
    elif IN64 in (size, place) or entries == IN64_COUNT:
        raise NotAPackage(f"{path}: ZIP64 directory without its locator")
    if disk != first_disk or here != entries:
        raise NotAPackage(f"{path}: archives of several parts are not read")
    if size > end:
        raise NotAPackage(f"{path}: central directory is cut off")
    return end - size, size, entries, end - size - place


def members(path: str) -> dict[str, Member]:
    """Members of a ZIP archive by its central directory."""
    place, size, entries, before = _directory(path)
    raw, at, out = _bytes(path, place, size), 0, {}
    for _ in range(entries):
        if raw[at : at + 4] != ENTRY or at + 46 > len(raw):
            raise NotAPackage(f"{path}: bad entry in the central directory")
        flags, method, _, _, crc, packed, full, n_name, n_extra, n_note, disk, _, _, header = struct.unpack_from("<HHHHIIIHHHHHII", raw, at + 8)
        name = raw[at + 46 : at + 46 + n_name]
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        k = 0
        while k + 4 <= len(extra):
            tag, length = struct.unpack_from("<HH", extra, k)
            if tag == EXTRA64:  # only the fields that do not fit, in this order
                wide = iter(struct.unpack_from(f"<{min(length, len(extra) - k - 4) // 8}Q", extra, k + 4))
                try:
                    full = next(wide) if full == IN64 else full
                    packed = next(wide) if packed == IN64 else packed
                    header = next(wide) if header == IN64 else header
                except StopIteration:
                    raise NotAPackage(f"{path}: ZIP64 field is cut off") from None
            k += 4 + length
        member = Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, flags, crc, packed, full, header + before)
        out[member.name] = member
        at += 46 + n_name + n_extra + n_note
    return out


def stored_range(path: str, member: Member) -> tuple[int, int]:
    """(place, size) of a stored member's bytes in the file, by its local header."""
    if member.method != 0 or member.flags & 1:
        raise NotAPackage(f"{path}: {member.name} is compressed or encrypted, so it has no ranges")
    local = _bytes(path, member.header, 30)
    if local[:4] != LOCAL:
        raise NotAPackage(f"{path}: no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n_name + n_extra, member.size


# ------------------------------------------------------------------ records


def _uri(text: str | None) -> str | None:
    """Percent codes for control characters, blanks and characters beyond ASCII; the rest as it is."""
    return None if text is None else urllib.parse.quote(text, safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _block(headers: list[tuple[str, str | None]], body: bytes) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in headers if v is not None) + b"\r\n" + body


def page_record(page_id, url: str | None, payload: bytes, sha1: bytes, stands_for) -> bytes:
    """A response record, or a revisit of the page ``stands_for[0]``."""
    digest = "sha1:" + base64.b32encode(sha1).decode()
    http = b"HTTP/1.1 200 OK\r\n" + _block([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], b"" if stands_for else payload)
    head = [
        ("WARC-Type", "revisit" if stands_for else "response"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # pages have no date; equal runs give equal records
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(http).digest()).decode()),
        ("WARC-Refers-To", f"<urn:page:{stands_for[0]}>" if stands_for else None),
        ("WARC-Profile", PROFILE if stands_for else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http))),
    ]
    return VERSION + b"\r\n" + _block(head, http) + b"\r\n\r\n"


def _headers(raw: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(first line, headers by lower-cased name, what follows)."""
    head, mark, body = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not mark:
        raise ValueError("record headers are cut off")
    pairs = (line.decode().partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in pairs}, body


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "None") else None


def read_record(raw: bytes) -> dict:
    """One WARC record as a row; digests are checked."""
    version, head, rest = _headers(raw)
    if version != VERSION:
        raise ValueError(f"not a WARC 1.1 record: {version!r}")
    block = rest[: int(head["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    if head["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError(f"block of {head['warc-record-id']} is damaged")
    _, http, payload = _headers(block)
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
    kind = head["warc-type"]
    if kind == "response" and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {head['warc-record-id']} is damaged")
    return {
        "page_id": _page(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(head.get("warc-refers-to")),
        "payload_bytes": int(http["content-length"]),
        "payload_digest": digest.hex(),
        "payload": payload if kind == "response" else None,
    }


# ------------------------------------------------------------------ writing


def package(records: list[bytes], index: list[dict], zip64: bool = False) -> bytes:
    """A package of gzipped records as bytes."""
    out = io.BytesIO()
    lines = "".join(json.dumps(x, separators=(",", ":")) + "\n" for x in index).encode()
    about = json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}).encode()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, parts in ((DATA, records), (INDEX, [lines]), (ABOUT, [about])):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64 or sum(map(len, parts)) >= 1 << 31) as m:
                for p in parts:
                    m.write(p)
    return out.getvalue()


def with_stored(d: DataFrame) -> DataFrame:
    """``d`` (page_id, url, html) with ``stored``, the largest id of its payload, and whether the page is a ``revisit`` of it.

    The table of payloads that repeat is broadcast if its rows, counted, are few enough; else pages meet it by a join whose key is
    salted, as one payload may hold a third of all pages."""
    digest, size = F.sha2(F.col("html").cast("binary"), 256), F.octet_length("html")
    keys = d.where(size >= REVISIT_BYTES).select("page_id", digest.alias("digest"), size.alias("size"))
    # one row a payload leaves each task
    same = keys.groupBy("digest", "size").agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n"))
    same = cut(same.where("n > 1").select("digest", "size", "stored"), "repeated-payloads")
    d = d.withColumn("digest", digest).withColumn("size", size)
    if same.count() <= BROADCAST_ROWS:
        d = d.join(F.broadcast(same), ["digest", "size"], "left")
    else:
        salted = same.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = d.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        d = d.join(salted, ["digest", "size", "salt"], "left")
    revisit = F.col("stored").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stored"))
    return d.select("page_id", "url", "html", revisit.alias("revisit"), "stored")


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", zip64: bool = False) -> DataFrame:
    """Write one record for each page into packages under ``folder`` (by default a new one in the shared checkpoint folder).
    Returns the manifest: file, n_records, n_bytes."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    d = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    d = with_stored(d)
    limit = PACKAGE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        index: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{folder}/{uuid.uuid4().hex}.wacz"
            n = write_shared(name, [package(records, index, zip64)])
            row = pa.RecordBatch.from_pydict({"file": [name], "n_records": [len(records)], "n_bytes": [n]})
            records.clear()
            index.clear()
            return row

        for batch in batches:
            for page_id, url, html, revisit, stored in zip(*(c for c in batch.columns)):
                payload = html.as_buffer().to_pybytes()
                raw = page_record(page_id.as_py(), url.as_py(), payload, hashlib.sha1(payload).digest(), (stored.as_py(),) if revisit.as_py() else None)
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                records.append(z.compress(raw) + z.flush())
                index.append({"id": page_id.as_py(), "offset": size, "length": len(records[-1])})
                size += len(records[-1])
                if size >= limit:
                    yield flush()
                    size = 0
        if records:
            yield flush()

    return cut(d.mapInArrow(tidy(run), "file string, n_records bigint, n_bytes bigint"), "warc-manifest")


# ------------------------------------------------------------------ reading


def package_ranges(path: str, limit: int = RANGE_BYTES) -> Iterator[tuple[int, list[int]]]:
    """Ranges of neighbouring records of a package, of about ``limit`` bytes: (place in the file, sizes)."""
    inside = members(path)
    data, size = stored_range(path, inside[DATA])
    at, length = stored_range(path, inside[INDEX])
    lines = _bytes(path, at, length)
    if zlib.crc32(lines) != inside[INDEX].crc:
        raise NotAPackage(f"{path}: index is damaged")
    start, sizes = 0, []
    for line in lines.splitlines():
        entry = json.loads(line)
        offset, n = entry["offset"], entry["length"]
        if offset < 0 or n < 0 or offset + n > size:
            raise NotAPackage(f"{path}: index names a record outside its archive")
        if sizes and (offset != start + sum(sizes) or sum(sizes) >= limit):
            yield data + start, sizes
            sizes = []
        if not sizes:
            start = offset
        sizes.append(n)
    if sizes:
        yield data + start, sizes


RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every record of the packages in ``manifest`` (a table with their paths as ``file``): page_id, url, record_type,
    refers_to, payload_bytes and payload_digest (of the full payload, also for revisits), payload (null for revisits)."""

    limit = RANGE_BYTES

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["file"]:
                found = list(package_ranges(path, limit))
                yield pd.DataFrame({"file": [path] * len(found), "start": [a for a, _ in found], "sizes": [s for _, s in found]})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for path, start, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                raw = memoryview(_bytes(path, start, sum(sizes)))
                ends = np.r_[0, np.cumsum(sizes)].tolist()
                rows = [read_record(zlib.decompress(raw[a:b], 31)) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    def spread(d: DataFrame, each: int, *by: str) -> DataFrame:
        """Dealt to one task for ``each`` rows, and to all cores at least if there are rows enough."""
        n = d.count()
        return d.repartition(max(1, n // each, min(n, 2 * d.sparkSession.sparkContext.defaultParallelism)), *by)

    files = spread(manifest.select("file"), 16, "file")
    ranges = cut(files.mapInPandas(tidy(plan), "file string, start bigint, sizes array<bigint>"), "warc-ranges")
    return spread(ranges, 16, "file", "start").mapInArrow(tidy(read), RECORD)
