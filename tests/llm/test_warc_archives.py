"""Archives of other writers, damage, and what a reader does not decode."""

import gzip
import io
import os
import random

import pyarrow as pa
import pytest

from ledgerwright.llm import warc

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def _record(kind, block, content=None, **more):
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:x:{kind}>", "Content-Type": content,
               "Content-Length": str(len(block)), **more}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _read(spark, folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, data in files.items():
        (folder / name.replace("_", ".")).write_bytes(data)
    return warc.read_archives(spark, str(folder))


def test_several_records_in_a_member(spark, tmp_path):
    one = _record("response", HTTP + b"a\r\n\r\nb", "application/http; msgtype=response")
    two = _record("conversion", b"plain\r\n\r\ntext", "text/plain")
    got = _read(spark, tmp_path / "a", x_warc_gz=gzip.compress(one + two) + gzip.compress(one)).collect()
    assert sorted((r.record_type, bytes(r.payload), r.payload_bytes) for r in got) == [
        ("conversion", b"plain\r\n\r\ntext", 13), ("response", b"a\r\n\r\nb", 6), ("response", b"a\r\n\r\nb", 6)]


def test_a_record_over_two_members_and_plain_files(spark, tmp_path):
    one = _record("resource", b"first\r\n\r\nsecond", "text/html")
    split = gzip.compress(one[:40]) + gzip.compress(one[40:]) + b"\0" * 100
    got = _read(spark, tmp_path / "a", x_warc_gz=split, y_warc=one + one, z_warc=b"").collect()
    assert [bytes(r.payload) for r in got] == [b"first\r\n\r\nsecond"] * 3


def test_header_names_in_any_case_folded_and_repeated(spark, tmp_path):
    head = (b"WARC/1.0\r\nwarc-type: Response\r\nwarc-record-id: <urn:x:1>\r\nwarc-target-uri: http://a/\r\n  b\r\n"
            b"WARC-Concurrent-To: <p>\r\nwarc-concurrent-to: <q>\r\ncontent-type: application/http\r\ncontent-length: ")
    block = HTTP + b"body"
    data = head + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    got = _read(spark, tmp_path / "a", x_warc_gz=gzip.compress(data * 2)).collect()
    assert [(r.record_id, r.record_type, r.target_uri, bytes(r.payload), r.headers["WARC-Concurrent-To"]) for r in got] == [
        ("urn:x:1", "response", "http://a/ b", b"body", "<p>, <q>")] * 2


def test_payload_by_type(spark, tmp_path):
    http = "application/http; msgtype=response"
    data = (_record("warcinfo", b"software: x\r\n\r\n", "application/warc-fields") + _record("response", b"dns\r\n\r\nx", "text/dns")
            + _record("revisit", HTTP, http) + _record("revisit", b"") + _record("request", b"GET / HTTP/1.1\r\n\r\n", "application/http")
            + _record("revisit", b"HTTP/1.1 200 OK\r\ncontent-length: 7\r\n\r\n", http) + _record("response", b"HTTP/1.1 200 OK", http))
    folder = tmp_path / "a"
    got = _read(spark, folder, x_warc=data).collect()
    want = [("warcinfo", 15, b"software: x\r\n\r\n"), ("response", 8, b"dns\r\n\r\nx"), ("revisit", None, None),
            ("revisit", None, None), ("request", 0, b""), ("revisit", 7, None), ("response", 0, b"")]
    assert [(r.record_type, r.payload_bytes, r.payload and bytes(r.payload)) for r in got] == [
        (kind, size, payload if payload != b"" else got[i].payload and b"") for i, (kind, size, payload) in enumerate(want)]
    headers = warc.read_archives(spark, str(folder), payload=False).collect()
    assert [(r.record_type, r.payload_bytes, r.payload) for r in headers] == [(k, n, None) for k, n, _ in want]


@pytest.mark.parametrize("damage", [
    lambda whole: gzip.compress(whole)[:-20], lambda whole: gzip.compress(whole) + gzip.compress(whole)[:30],
    lambda whole: whole[:-30], lambda whole: b"no archive\r\n" + whole, lambda whole: whole.replace(b"Content-Length: 4000", b"X: 1"),
    lambda whole: whole[:60], lambda whole: warc._member(whole)[:-1500]])
def test_damage_is_an_error(spark, tmp_path, damage):
    block = random.Random(1).randbytes(4000)
    data = damage(_record("resource", block, "image/png"))
    for payload in (True, False):
        (tmp_path / "x.warc.gz").write_bytes(data)
        with pytest.raises(Exception, match="damaged archive"):
            warc.read_archives(spark, str(tmp_path), payload=payload).collect()


def test_every_cut_of_an_archive_reads_whole_records_or_fails():
    record = _record("resource", b"abc" * 50, "text/plain")
    for packed in (gzip.compress(record * 3), gzip.compress(record) * 3, record * 3, warc._member(record) * 3):
        for cut in range(0, len(packed), 7):
            archive, n = warc._Archive(pa.PythonFile(io.BytesIO(packed[:cut]), mode="r")), 0
            try:
                while (headers := archive.record()) is not None:
                    assert archive.payload(headers, True) == (150, b"abc" * 50)
                    n += 1
            except (ValueError, warc.zlib.error):
                pass
            assert n <= 3


def test_unwanted_payloads_are_not_inflated():
    rng = random.Random(2)
    rows = [{"record_id": f"urn:x:{i}", "record_type": "response", "refers_to": None, "payload": rng.randbytes(400_000)}
            for i in range(10)]
    packed = b"".join(warc._member(warc.record(row)) for row in rows)
    archive, sizes = warc._Archive(pa.PythonFile(io.BytesIO(packed), mode="r")), []
    while (headers := archive.record()) is not None:
        sizes.append(archive.payload(headers, False))
    assert sizes == [(400_000, None)] * 10
    assert archive.inflated <= 10 * 2 * warc.PART_BYTES
    archive, payloads = warc._Archive(pa.PythonFile(io.BytesIO(packed), mode="r")), []
    while (headers := archive.record()) is not None:
        payloads.append(archive.payload(headers, len(payloads) % 2 == 0)[1])
    assert payloads == [row["payload"] if i % 2 == 0 else None for i, row in enumerate(rows)]


def test_null_and_repeated_page_ids(spark):
    pages = [(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (2, "u", "y"), (None, None, "z"), (1, "u", "w")]
    got = warc.page_archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == [
        (0, 1, "response", 0), (0, 1, "revisit", 1), (1, 1, "response", 0), (1, 1, "response", 0), (1, 1, "response", 0),
        (2, 1, "response", 0)]
