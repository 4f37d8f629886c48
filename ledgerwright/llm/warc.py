"""WARC archives as a Spark Python data source.

Writing: each task writes gzip-per-record archives of bounded size; only files of
committed tasks are listed in the folder's manifest, so a lost or repeated task leaves
nothing behind that a reader sees. Each gzip member tells its own length in an extra
field, so a reader can step over a record without inflating it.

Reading: one partition per archive file (by the manifest, or every ``.warc`` and
``.warc.gz`` file below the path). Predicates on columns that come from headers
(equal, in, null checks, comparisons) are pushed to the reader. Of each record the
headers are inflated and parsed first. The payload of a record that the predicates
reject, or that nobody asks for (option ``payload`` = ``false``), is not made a value; in
archives written here it is not inflated either, and its size comes from the lengths told.

Archives from elsewhere are read whole: any number of records in a gzip member, a record
over several members, plain files, header names in any case, folded header lines. The
payload is the block less its HTTP head where the block is HTTP, the whole block
otherwise (``resource``, ``conversion``, ``metadata``, ...), as transferred; a revisit has
none, and its size is the one its HTTP head tells (null if it tells none).

Defined cases: a null payload is empty; a missing header is null, a repeated one is joined
by commas; control characters in header values are percent-encoded; equal records are
written each; an empty input writes an empty manifest and reads back as an empty table;
zero bytes after the last member are ignored. A damaged archive (a member or record
that ends early, a wrong checksum of what is inflated, no record where one must start, no
valid Content-Length) is an error that names the file, never a row.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull,
                                    LessThan, LessThanOrEqual, Not, WriterCommitMessage)

from .common import Tables, bounded

ARCHIVE_BYTES = 64 << 20     # an archive is closed beyond this size
RAW_BYTES = 1 << 16          # read from a file at once
PART_BYTES = 1 << 13         # inflated at least at once
MANIFEST = "_manifest.json"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "payload_bytes long, refers_to string, headers map<string,string>, payload binary")
_HEADER_OF = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
              "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def _clean(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else quote(c) for c in value)


def _member(data: bytes) -> bytes:
    """One gzip member whose extra field ``sl`` holds its own length."""
    packer = zlib.compressobj(5, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 8 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHI", 8, b"sl", 4, size)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """The bytes of one response or revisit record."""
    payload = bytes(row["payload"] or b"")
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = {"WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"] and f"<{row['record_id']}>",
               "WARC-Date": row.get("date") or "1970-01-01T00:00:00Z", "WARC-Target-URI": row.get("target_uri"),
               "WARC-Payload-Digest": "sha1:" + payload_digest(payload),
               "WARC-Refers-To": row["refers_to"] and f"<{row['refers_to']}>",
               "WARC-Profile": PROFILE if revisit else None, "Content-Type": "application/http; msgtype=response",
               "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in headers.items() if v)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, rows):
        fs, folder = _folder(self.path)
        fs.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for row in rows:
            if out is None:
                files.append(f"{uuid.uuid4().hex}.warc.gz")
                out, size = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
            data = _member(record(row.asDict()))
            out.write(data)
            size += len(data)
            if size >= ARCHIVE_BYTES:
                out.close()
                out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages):
        fs, folder = _folder(self.path)
        fs.create_dir(folder, recursive=True)
        files = {f for m in messages if m for f in m.files}
        if not self.overwrite and fs.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
                files.update(json.loads(f.read()))
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(sorted(files)).encode())

    def abort(self, messages):
        fs, folder = _folder(self.path)
        for message in messages:
            for name in message.files if message else []:
                fs.delete_file(f"{folder}/{name}")


@dataclass
class _File(InputPartition):
    path: str


class _Archive:
    """Records of an archive, inflated only as far as they are asked for."""

    def __init__(self, stream):
        self.stream, self.size = stream, stream.size()
        self.raw = stream.read(RAW_BYTES)                  # read from the file, not yet used
        self.packed = self.raw[:2] == b"\x1f\x8b"
        self.ready, self.inflater = bytearray(), None      # inflated, not yet used
        self.member_end = self.alone_to = None             # where members end that tell their length
        self.left = self.inflated = 0                      # bytes of the block not yet used; bytes inflated in all

    def record(self) -> dict[str, str] | None:
        """Headers of the next record, whose block is not read yet; None at the end."""
        if self.alone_to is not None:
            self._leave()
        else:
            self._drop(self.left)
        fresh, line = self._fresh(), self._line()
        while line in (b"\r\n", b"\n"):
            fresh, line = self._fresh(), self._line()
        if not line:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError("no record where one must start")
        self.alone_to = self.member_end if fresh else None
        lines = []
        while (line := self._line()).strip(b"\r\n"):
            lines.append(line)
        if not line:
            raise ValueError("ends within the headers of a record")
        headers = _parse(lines)
        length = _header(headers, "Content-Length") or ""
        if not (length.isascii() and length.isdigit()):
            raise ValueError(f"no valid Content-Length: {length!r}")
        self.left = int(length)
        return headers

    def payload(self, headers: dict[str, str], decode: bool) -> tuple[int | None, bytes | None]:
        """Size and, if it is to be decoded, bytes of the payload of the record just met."""
        kind, content = _header(headers, "WARC-Type"), _header(headers, "Content-Type")
        http = {}
        if (content or "").lower().startswith("application/http") or (
                content is None and kind in ("response", "request", "revisit")):
            http = _parse(self._head().split(b"\n")[1:])
        if kind == "revisit":
            told = _header(http, "Content-Length") or ""
            return (int(told) if told.isascii() and told.isdigit() else None), None
        size = self.left
        return size, self._take(size) if decode else None

    def _more(self, want: int) -> bool:
        """Some more of the file in ``ready``; False at its end."""
        if not self.raw:
            self.raw = self.stream.read(RAW_BYTES)
        if not self.packed:
            self.ready += self.raw
            more, self.raw = bool(self.raw), b""
            return more
        if self.inflater is None and not self._open():
            return False
        if not self.raw:
            raise ValueError("ends within a gzip member")
        out = self.inflater.decompress(self.raw, min(max(want, PART_BYTES), 16 * RAW_BYTES))
        self.ready += out
        self.inflated += len(out)
        if self.inflater.eof:
            self.raw, self.inflater = self.inflater.unused_data, None
        else:
            self.raw = self.inflater.unconsumed_tail
        return True

    def _open(self) -> bool:
        """Start the next member; False where none is left."""
        while True:
            if self.raw[:1] == b"\0":
                self.raw = self.raw.lstrip(b"\0")
            if len(self.raw) >= 20:
                break
            more = self.stream.read(RAW_BYTES)
            if not more:
                break
            self.raw += more
        if not self.raw:
            return False
        start = self.stream.tell() - len(self.raw)
        own = len(self.raw) >= 20 and self.raw[3:4] == b"\x04" and self.raw[12:16] == b"sl\x04\0"
        self.member_end = start + struct.unpack("<I", self.raw[16:20])[0] if own else None
        self.inflater = zlib.decompressobj(31)
        return True

    def _fresh(self) -> bool:
        """Whether the next byte is the first of a member."""
        while not self.ready and self.inflater is not None:
            self._more(PART_BYTES)
        return self.packed and not self.ready

    def _leave(self) -> None:
        """Step over what is left of a member that holds one record."""
        self.ready.clear()
        if self.inflater is not None:
            self.inflater = None
            beyond = self.stream.tell() - self.alone_to
            if self.alone_to > self.size or beyond > len(self.raw):
                raise ValueError("ends within a gzip member")
            if beyond < 0:
                self.stream.seek(self.alone_to)
            self.raw = self.raw[len(self.raw) - beyond:] if beyond > 0 else b""
        self.left, self.alone_to = 0, None

    def _drop(self, n: int) -> None:
        used = min(n, len(self.ready))
        del self.ready[:used]
        n -= used
        if n and not self.packed:
            at = self.stream.tell() - len(self.raw) + n
            if at > self.size:
                raise ValueError("ends within a record")
            self.stream.seek(at)
            self.raw, n = b"", 0
        while n:
            if not self.ready and not self._more(n):
                raise ValueError("ends within a record")
            used = min(n, len(self.ready))
            del self.ready[:used]
            n -= used
        self.left = 0

    def _take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more(n - len(self.ready)):
                raise ValueError("ends within a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        self.left -= n
        return out

    def _head(self) -> bytes:
        """The block up to its first empty line, or all of it."""
        seen = 0
        while (at := self.ready.find(b"\r\n\r\n", seen, self.left)) < 0:
            if len(self.ready) >= self.left:
                return self._take(self.left)
            seen = max(0, len(self.ready) - 3)
            if not self._more(PART_BYTES):
                raise ValueError("ends within a record")
        return self._take(at + 4)

    def _line(self) -> bytes:
        """The bytes to the next line feed; what is left at the end of the file."""
        seen = 0
        while (at := self.ready.find(b"\n", seen)) < 0:
            seen = len(self.ready)
            if not self._more(PART_BYTES):
                at = len(self.ready)
                break
        line = bytes(self.ready[:at + 1])
        del self.ready[:at + 1]
        return line


def _parse(lines: list[bytes]) -> dict[str, str]:
    """Header names as written (the first spelling, where cases differ) and their values."""
    out, spelling, last = {}, {}, None
    for line in lines:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and last is not None:
            out[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if colon:
            last = spelling.setdefault(name.strip().lower(), name.strip())
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def _header(headers: dict[str, str], name: str) -> str | None:
    if name in headers:
        return headers[name]
    return next((v for k, v in headers.items() if k.lower() == name.lower()), None)


def _values(headers: dict[str, str]) -> dict:
    row = {column: _header(headers, name) for column, name in _HEADER_OF.items()}
    for column in ("record_id", "refers_to"):
        if row[column]:
            row[column] = row[column].strip("<>")
    if row["record_type"]:
        row["record_type"] = row["record_type"].lower()
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    return row


_TESTS = {EqualTo: lambda a, b: a is not None and a == b, EqualNullSafe: lambda a, b: a == b,
          In: lambda a, b: a is not None and a in b, GreaterThan: lambda a, b: a is not None and a > b,
          GreaterThanOrEqual: lambda a, b: a is not None and a >= b, LessThan: lambda a, b: a is not None and a < b,
          LessThanOrEqual: lambda a, b: a is not None and a <= b}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for one in filters:
            inner, wanted = (one.child, False) if isinstance(one, Not) else (one, True)
            column = ".".join(getattr(inner, "attribute", ()))
            if column in _HEADER_OF and type(inner) in (IsNull, IsNotNull):
                self.tests.append((column, "null", None, wanted == (type(inner) is IsNull)))
            elif column in _HEADER_OF and type(inner) in _TESTS and wanted:
                self.tests.append((column, type(inner), inner.value, True))
            else:
                yield one

    def partitions(self):
        fs, folder = _folder(self.path)
        listed = fs.get_file_info(f"{folder}/{MANIFEST}")
        if listed.type == pafs.FileType.File:
            with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
                names = [f"{folder}/{n}" for n in json.loads(f.read())]
        elif fs.get_file_info(folder).type == pafs.FileType.File:
            names = [folder]
        else:
            names = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(folder, recursive=True))
                           if i.path.endswith((".warc", ".warc.gz")))
        return [_File(n) for n in names] or [_File("")]

    def _wanted(self, row: dict) -> bool:
        for column, kind, value, wanted in self.tests:
            got = row[column]
            if ((got is None) if kind == "null" else _TESTS[kind](got, value)) != wanted:
                return False
        return True

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = _folder(self.path)
        with fs.open_input_file(partition.path) as stream:
            try:
                archive = _Archive(stream)
                while (headers := archive.record()) is not None:
                    row = _values(headers)
                    if self._wanted(row):
                        size, payload = archive.payload(headers, self.payload)
                        yield (*(row[c] for c in ("record_id", "record_type", "target_uri", "date", "payload_digest")),
                               size, row["refers_to"], headers, payload)
            except (ValueError, zlib.error) as damage:
                raise ValueError(f"damaged archive {partition.path}: {damage}") from damage


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_archives(records: DataFrame, path: str) -> None:
    """Write rows (record_id, record_type, refers_to, target_uri, date, payload)."""
    register(records.sparkSession)
    records.select("record_id", "record_type", "refers_to", F.col("target_uri").cast("string"),
                   F.col("date").cast("string"), "payload").write.format("warc").mode("append").save(path)


def mark_revisits(pages: DataFrame, tables: Tables, id_column: str, payload: Column,
                  least_bytes: int = 0) -> DataFrame:
    """``pages`` with payload, record_type and refers_to.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the
    largest id is the response that the others revisit. The largest ids of repeated
    payloads are a partial aggregate over digests, written and joined back, so a group
    of copies of any size is never gathered and a hot digest can be split.
    """
    rows = pages.withColumn("payload", payload)
    digest = F.sha2("payload", 256)
    groups = rows.where(F.length("payload") >= least_bytes).groupBy(digest.alias("_digest")).agg(
        F.count("*").alias("_n"), F.max(id_column).alias("_last")).where("_n > 1 and _last is not null")
    groups = tables.put(groups.select("_digest", "_last"), "repeated-payloads")
    out = rows.withColumn("_digest", digest).join(bounded(groups), "_digest", "left")
    other = F.col("_last").isNotNull() & (F.col(id_column).isNull() | (F.col(id_column) != F.col("_last")))
    return (out.withColumn("record_type", F.when(other, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(other, F.col("_last"))).drop("_digest", "_last"))


def page_archive(pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    tables = Tables(pages.sparkSession, "warc")
    named = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").alias("target_uri"), "html")
    rows = mark_revisits(rows, tables, "page_id", F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    write_archives(rows.select(F.coalesce(named("page_id"), F.lit("urn:page:")).alias("record_id"), "record_type",
                               named("refers_to").alias("refers_to"), "target_uri", F.lit(None).alias("date"),
                               "payload"), tables.path("archives"))
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as long)")
    return read_archives(pages.sparkSession, tables.path("archives"), payload=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
