"""Web archives in ZIP packages: written by tasks, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx`` (offset and length of each), both stored without further
compression, so a record can be fetched with one range read. The reader parses the
end-of-central-directory record, its ZIP64 form and the central directory itself;
nothing is extracted.

Pages with equal payloads are written once: the page with the largest id is the
response, the others are revisits that name it. Which payloads repeat is settled
with digests only; html is not grouped.

Packages go to a folder that all executors and the driver reach through
``pyarrow.fs`` (local or shared file systems, HDFS, object stores). The rows that
successful tasks return are the manifest; files of lost attempts are not in it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import cut_lineage, scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# bytes of records after which a task starts another package
PACKAGE_BYTES = 1 << 30
# repeated payloads whose digests are broadcast (about 80 bytes each), beyond it shuffled
BROADCAST_DIGESTS = 200_000
# records of one package that one task reads in a row
READ_RECORDS = 2_000
# bytes of packages that one task reads back, about
READ_BYTES = 1 << 22
MANIFEST = "path string, size long, records long"


# --- records -------------------------------------------------------------

def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the response's headers and no body."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    def headers(part: bytes) -> dict[str, str]:
        pairs = (line.split(":", 1) for line in part.decode("utf-8").split("\r\n")[1:] if ":" in line)
        return {k.strip().lower(): v.strip() for k, v in pairs}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    block = rest[:int(warc["content-length"])]
    if len(block) < int(warc["content-length"]):
        raise ValueError(f"record {warc.get('warc-record-id')} is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, headers(http), payload


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


# --- packages ------------------------------------------------------------

def write_package(out, records: Iterator[bytes], limit: int = PACKAGE_BYTES) -> int:
    """Write records up to ``limit`` bytes to an open file; returns how many."""
    index, offset = [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(DATA, "w", force_zip64=True) as member:
            for record in records:
                data = gzip.compress(record, 6, mtime=0)
                member.write(data)
                index.append(f"{offset} {len(data)}\n")
                offset += len(data)
                if offset >= limit:
                    break
        with package.open(INDEX, "w", force_zip64=True) as member:
            member.write("".join(index).encode())
    return len(index)


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header: int


def read_directory(read, size: int) -> list[Member]:
    """Members from the central directory; ``read(offset, length)`` gives bytes.

    The end record is looked for backwards through the longest possible comment;
    where its fields are full, the ZIP64 record and the members' ZIP64 fields hold.
    """
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail)
                        or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = tail_at + end - 20
        mark, _, at, _ = struct.unpack("<4sIQI", read(locator, 20))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = read(at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read(start, length), 0, []
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        wide = _zip64_fields(extra)
        if plain == 0xFFFFFFFF:
            plain = wide.pop(0)
        if packed == 0xFFFFFFFF:
            packed = wide.pop(0)
        if header == 0xFFFFFFFF:
            header = wide.pop(0)
        members.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return members


def _zip64_fields(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
        at += 4 + length
    return []


def data_start(read, member: Member) -> int:
    """Where a stored member's bytes begin, after its local header."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed and cannot be read by ranges")
    header = read(member.header, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra


def open_file(path: str):
    where, inner = fs.FileSystem.from_uri(path)
    return where.open_input_file(inner)


# --- Spark ---------------------------------------------------------------

def _writer(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        records = (record_bytes(r["page_id"], r["url"], r["html"].encode("utf-8", "replace"),
                                r["refers_to"], r["revisit"]) for r in rows)
        where, inner = fs.FileSystem.from_uri(folder)
        where.create_dir(inner, recursive=True)
        for first in records:
            name = f"{uuid.uuid4().hex}.wacz"

            def rest(first: bytes = first) -> Iterator[bytes]:
                yield first
                yield from records

            with where.open_output_stream(f"{inner}/{name}") as out:
                written = write_package(out, rest(), limit)
            size = where.get_file_info(f"{inner}/{name}").size
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size],
                                              "records": [written]})
    return run


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with html as text, ``revisit`` and ``refers_to``.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the
    largest page_id are responses. Rows without an id are revisits only of a page
    that has one.
    """
    full = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    repeated = cut_lineage(
        full.where(F.octet_length("html") >= min_bytes).select("page_id", digest.alias("d"))
        .groupBy("d").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null").select("d", "first_id"))
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    revisit = F.coalesce(F.col("first_id") != F.coalesce(F.col("page_id"), F.col("first_id") - 1),
                         F.lit(False))
    return (full.withColumn("d", digest).join(repeated, "d", "left")
            .select("page_id", "url", "html", revisit.alias("revisit"),
                    F.when(revisit, F.col("first_id")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0,
                   limit: int = PACKAGE_BYTES) -> DataFrame:
    """Write every page as a record; returns the manifest (path, size, records)."""
    return cut_lineage(roles(pages, min_bytes).mapInArrow(_writer(folder, limit), MANIFEST))


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, size in zip(batch["path"], batch["size"]):
            with open_file(path) as f:
                def read(offset: int, length: int) -> bytes:
                    return f.read_at(length, offset)

                members = {m.name: m for m in read_directory(read, size)}
                start = data_start(read, members[DATA])
                lines = read(data_start(read, members[INDEX]), members[INDEX].size).split(b"\n")
            places = [tuple(map(int, line.split())) for line in lines if line]
            for i in range(0, len(places), READ_RECORDS):
                part = places[i:i + READ_RECORDS]
                yield pd.DataFrame({"path": [path], "offsets": [[start + a for a, _ in part]],
                                    "lengths": [[n for _, n in part]]})


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            found, held = [], 0
            with open_file(row["path"]) as f:
                for offset, length in zip(row["offsets"], row["lengths"]):
                    warc, http, payload = parse_record(gzip.decompress(f.read_at(length, offset)))
                    digest = warc["warc-payload-digest"].removeprefix("sha1:")
                    kind = warc["warc-type"]
                    if kind == "response" and base32_sha1(payload) != digest:
                        raise ValueError(f"damaged record in {row['path']} at {offset}")
                    found.append({
                        "page_id": page_of(warc["warc-record-id"]),
                        "payload_bytes": int(http["content-length"]), "payload_digest": digest,
                        "record_type": kind, "refers_to": page_of(warc.get("warc-refers-to")),
                        "url": warc["warc-target-uri"],
                        "payload": payload if kind == "response" else None})
                    held += len(payload)
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, held = [], 0
            if found:
                yield pa.RecordBatch.from_pylist(found, schema)


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the packages in a manifest, with the payload of responses."""
    ranges = manifest.select("path", "size").mapInPandas(
        _index, "path string, offsets array<long>, lengths array<long>")
    # a number: the offsets are small, and it is the bytes behind them that are read
    parts = -(-(manifest.agg(F.sum("size")).first()[0] or 1) // READ_BYTES)
    return ranges.repartition(parts, F.xxhash64("path", "offsets")).mapInArrow(
        _records, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                  "refers_to long, url string, payload binary")


def archive_digest(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages to packages in the shared folder and report what is read back.

    One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to. A null html is an empty payload, and all empty payloads are equal.
    Repeated rows of one page are all responses (or all revisits). An empty table
    gives an empty result; other columns are ignored.
    """
    folder = f"{scratch_path(pages.sparkSession)}-archives"
    return read_archives(write_archives(pages, folder, min_bytes=min_bytes)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
