import io
import struct
import zipfile

import pytest

from contrail.llm import warc_zip
from contrail.llm.warc_zip import data_start, parse_record, read_directory, record_bytes, write_package

PAGES = "page_id long, url string, html string, path string, d string, size string"


def reader(data):
    return lambda offset, length: data[offset:offset + length]


@pytest.mark.parametrize("wide", [False, True])
def test_directories(monkeypatch, wide):
    if wide:
        # sizes and offsets of this length count as too large for the short fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(4):
            z.writestr(f"m{i}", b"x" * (i * 30))
        z.comment = b"PK\x05\x06 in a comment"
        infos = z.infolist()
    data = out.getvalue()
    assert (b"PK\x06\x06" in data) == wide
    members = read_directory(reader(data), len(data))
    assert [(m.name, m.size, m.header) for m in members] == [
        (i.filename, i.compress_size, i.header_offset) for i in infos]
    for i, m in enumerate(members):
        start = data_start(reader(data), m)
        assert data[start:start + m.size] == b"x" * (i * 30)


def test_broken_packages():
    with pytest.raises(ValueError, match="central directory"):
        read_directory(reader(b"no package"), 10)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "b" * 100)
    with pytest.raises(ValueError, match="compressed"):
        data_start(reader(out.getvalue()), read_directory(reader(out.getvalue()), len(out.getvalue()))[0])
    with pytest.raises(ValueError, match="cut short"):
        parse_record(record_bytes(1, "u", b"payload", None, False)[:-9])


def test_records_round_trip():
    warc, http, payload = parse_record(record_bytes(-5, "http://x/\r\na b", "é\r\n\r\n".encode(), None, False))
    assert warc["warc-target-uri"] == "http://x/%0D%0Aa%20b" and payload == "é\r\n\r\n".encode()
    warc, http, payload = parse_record(record_bytes(None, None, b"abc", 7, True))
    assert payload == b"" and http["content-length"] == "3"
    assert warc_zip.page_of(warc["warc-refers-to"]) == 7 and warc_zip.page_of(warc["warc-record-id"]) is None


def test_package_stops_at_its_limit():
    records = iter([b"a" * 100] * 10)
    out = io.BytesIO()
    assert write_package(out, records, 60) < 10
    assert struct.unpack_from("<4s", out.getvalue())[0] == b"PK\x03\x04"


@pytest.mark.parametrize("digests,limit,min_bytes", [(200_000, 1 << 30, 0), (0, 200, 4)])
def test_pages(spark, monkeypatch, tmp_path, digests, limit, min_bytes):
    monkeypatch.setattr(warc_zip, "BROADCAST_DIGESTS", digests)
    monkeypatch.setattr(warc_zip, "READ_RECORDS", 3)
    rows = [(1, "a", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "c", "x" * 300_000), (4, "d", None), (5, "e", ""),
            (6, "f", "ü"), (7, "g", "ü"), (8, "h", "<p>same</p>"), (8, "h", "<p>same</p>"), (None, "i", "<p>same</p>"),
            (None, "j", "alone")]
    pages = spark.createDataFrame([(*r, "p", "q", "r") for r in rows], PAGES)
    manifest = warc_zip.write_archives(pages, f"{tmp_path}/archives", min_bytes=min_bytes, limit=limit)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    got = warc_zip.read_archives(manifest).collect()
    small = min_bytes > 2
    expected = {(1, 11, "revisit", 8), (2, 11, "revisit", 8), (3, 300_000, "response", None),
                (4, 0, *(("response", None) if small else ("revisit", 5))), (5, 0, "response", None),
                (6, 2, *(("response", None) if small else ("revisit", 7))), (7, 2, "response", None),
                (8, 11, "response", None), (None, 11, "revisit", 8), (None, 5, "response", None)}
    assert {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got} == expected
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[3].payload == b"x" * 300_000 and by_id[5].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert warc_zip.archive_digest(pages.limit(0)).collect() == []


def test_packages_are_read_back_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "READ_BYTES", 1_000)
    monkeypatch.setattr(warc_zip, "READ_RECORDS", 2)
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 40) for i in range(60)], "page_id long, url string, html string")
    manifest = warc_zip.write_archives(pages, f"{warc_zip.scratch_path(spark)}-archives")
    read = warc_zip.read_archives(manifest)
    assert read.rdd.getNumPartitions() == -(-sum(r["size"] for r in manifest.collect()) // 1_000) > 3
    assert sorted(r["page_id"] for r in read.select("page_id").collect()) == list(range(60))
