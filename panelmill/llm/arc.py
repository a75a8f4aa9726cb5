"""Legacy ARC archives to WARC.

An ARC file is a run of records: a header line, the declared number of bytes, a
line feed. The first record (``filedesc:``) holds the version block: version,
reserved number and origin, then the names of the header fields. Version 1
lines have 5 fields (URL, IP address, date, content type, length), version 2
lines 10 (result code, checksum, location, offset and file name before the
length). URLs may hold spaces, so fields are counted from the end.

Files may be compressed by record (gzip members) or not at all.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.batches import slices
from panelmill.llm.shared import file_system, map_batches, stored
from panelmill.llm.skew import look_up

#: Fields of a header line by the version of the file.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = b"X-Archive-Key"
FILE_BYTES = 64 << 20
FAST = 1
LEAST_REVISIT = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs


class Stream:
    """Bytes of a file, gzip members taken apart, read as lines and blocks."""

    def __init__(self, file, step: int = 1 << 20):
        self.file, self.step = file, step
        self.buffer, self.at, self.total = b"", 0, 0
        head = file.read(step)
        self.zip = zlib.decompressobj(31) if head[:2] == b"\x1f\x8b" else None
        self.raw, self.done = head, not head
        self._more()

    def _more(self) -> bool:
        if self.done:
            return False
        data = b""
        while not data and not self.done:
            raw = self.raw or self.file.read(self.step)
            self.raw = b""
            if not raw:
                self.done = True
            elif self.zip is None:
                data = raw
            else:
                parts = []
                while raw:
                    parts.append(self.zip.decompress(raw))
                    raw = self.zip.unused_data
                    if self.zip.eof:
                        self.zip = zlib.decompressobj(31)
                data = b"".join(parts)
        self.buffer = self.buffer[self.at:] + data
        self.at = 0
        return bool(data)

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more():
                if self.at == len(self.buffer):
                    return None
                end = len(self.buffer)
                break
        found = self.buffer[self.at:end]
        self.total += end + 1 - self.at
        self.at = min(end + 1, len(self.buffer))
        return found

    def block(self, size: int) -> bytes:
        """The next ``size`` bytes; fewer raise, since the declared length is then wrong."""
        if len(self.buffer) - self.at < size:
            parts, have = [self.buffer[self.at:]], len(self.buffer) - self.at
            self.at = len(self.buffer)
            while have < size and self._more():
                parts.append(self.buffer)
                have += len(self.buffer)
                self.at = len(self.buffer)
            self.buffer, self.at = b"".join(parts), 0
            if have < size:
                raise ValueError(f"a record declares {size} bytes and the file ends after {have}")
        found = self.buffer[self.at:self.at + size]
        self.at += size
        self.total += size
        return found


@dataclass
class ArcRecord:
    """One record of an ARC file; ``number`` counts from the version block, 0."""

    number: int
    version: int
    url: str
    fields: dict[str, str]
    block: bytes
    http: dict[bytes, bytes] = field(default_factory=dict)
    head: bytes = b""
    payload: bytes = b""


def arc_records(file) -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block; header lines are read by the file's version."""
    stream = Stream(file)
    first = stream.line()
    if first is None:
        return
    if not first.startswith(b"filedesc:"):
        raise ValueError("an ARC file begins with a filedesc record")
    described = stream.block(int(first.rsplit(b" ", 1)[1])).split(b"\n")
    version = int(described[0].split(b" ")[0])
    names = (described[1].decode() if len(described) > 1 and described[1].strip() else FIELDS[version]).split(" ")
    number = 0
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(names) - 1)
        if len(parts) != len(names):
            raise ValueError(f"a header line has {len(parts)} of {len(names)} fields: {line[:200]!r}")
        fields = dict(zip(names, parts, strict=True))
        number += 1
        record = ArcRecord(number, version, parts[0], fields, stream.block(int(parts[-1])))
        record.payload = record.block
        if record.block.startswith(b"HTTP/"):
            head, gap, body = record.block.partition(b"\r\n\r\n")
            if gap:
                record.head, record.payload = head + gap, body
                pairs = (h.partition(b":") for h in head.split(b"\r\n")[1:])
                record.http = {k.strip().lower(): v.strip() for k, _, v in pairs}
        yield record


def warc_date(arc_date: str) -> str:
    """14 digits (12 without seconds, 8 without a time) as an ISO date in UTC; midnight 1970 if unreadable."""
    digits = arc_date.strip()[:14].ljust(14, "0")
    try:
        return datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(arc: str, number: int) -> str:
    """The same identifier for the same place in the same archive."""
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'{arc}#{number}')}"


def warc_type(record: ArcRecord) -> str:
    """response for HTTP and DNS answers, metadata for what crawlers noted, else resource."""
    if record.head or record.url.startswith("dns:"):
        return "response"
    return "metadata" if record.url.startswith("metadata:") else "resource"


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()  # noqa: S324


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(FAST, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _warc(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.0", *(f"{k}: {v}".encode() for k, v in headers if v), b"Content-Length: %d" % len(block)]
    return _member(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n")


def warc_records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file; header names in lower case."""
    stream = Stream(file)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        headers = {}
        while (line := stream.line()) is not None and line.strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.block(int(headers["content-length"]))


# -- archives on Spark ---------------------------------------------------------

FILES = "path string, archive string, records bigint, bytes bigint"
_EPOCH = datetime(2001, 1, 1, tzinfo=timezone.utc)


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write pages as ARC files, of both versions in turn, and return the files.

    A page is an HTTP answer whose body is the page in UTF-8 (a null: empty) and
    whose headers carry the key. A null URL becomes ``urn:none``; white space in URLs is kept.
    Each partition writes files of about 64 MB (before compression); a file has the
    attempt in its name, and only those of successful tasks are returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, inner = file_system(folder)
        out, count, size, files = None, 0, 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return _row([f"{folder}/{name}", name, count, size], FILES)

        for part in slices(batches, "body"):
            for k, u, b in zip(*(part.column(c).to_pylist() for c in ("key", "url", "body")), strict=True):
                if out is None:
                    version = 1 + (context.partitionId() + files) % 2
                    name = f"part-{context.partitionId():06d}-{files:04d}-{context.taskAttemptId()}.arc.gz"
                    out, count, size = system.open_output_stream(f"{inner}/{name}", compression=None), 0, 0
                    described = f"{version} 0 panelmill\n{FIELDS[version]}\n".encode()
                    more = {1: "", 2: f" 200 - - 0 {name}"}[version]
                    out.write(_member(f"filedesc://{name} 0.0.0.0 20010101000000 text/plain{more} {len(described)}\n".encode() + described + b"\n"))
                body_bytes = (b or "").encode()
                head = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(body_bytes)
                if k is not None:
                    head += KEY_HEADER + b": %d\r\n" % k
                block = head + b"\r\n" + body_bytes
                date = (_EPOCH + timedelta(seconds=count)).strftime("%Y%m%d%H%M%S")
                target = " ".join((u or "urn:none").split("\n"))
                more = {1: "", 2: f" 200 {base32_sha1(body_bytes)[5:]} - {size} {name}"}[version]
                line = f"{target} 0.0.0.0 {date} text/html{more} {len(block)}\n".encode()
                out.write(_member(line + block + b"\n"))
                count += 1
                size += len(line) + len(block) + 1
                if size >= FILE_BYTES:
                    yield close()
                    out, files = None, files + 1
        if out is not None:
            yield close()

    rows = pages.select(pages[key].cast("long").alias("key"), pages[url].cast("string").alias("url"), pages[body].cast("string").alias("body"))
    return stored(map_batches(rows, run, FILES), "arc-files")


def _row(values: list, schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)


def _each_file(files: DataFrame) -> DataFrame:
    """The files, each in a task of its own as far as possible."""
    return files.repartition(min(max(1, files.count()), 20_000), "path")


FOUND = "path string, archive string, number bigint, record_id string, key bigint, url string, date string, digest binary, payload_bytes bigint, content_type string"


def scan_arc(files: DataFrame) -> DataFrame:
    """What the records of ARC files are, without their contents: one narrow row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, archive in zip(batch.column("path").to_pylist(), batch.column("archive").to_pylist(), strict=True):
                system, inner = file_system(path)
                rows = []
                with system.open_input_stream(inner, compression=None) as file:
                    for r in arc_records(file):
                        key = r.http.get(KEY_HEADER.lower())
                        rows.append((
                            path, archive, r.number, record_id(archive, r.number), int(key) if key else None, r.url,
                            warc_date(r.fields["Archive-date"]), hashlib.sha1(r.payload).digest(),  # noqa: S324
                            len(r.payload), r.fields["Content-type"],
                        ))
                for i in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[i:i + 10_000], strict=True))
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=[c.split()[0] for c in FOUND.split(", ")],
                    )

    return stored(map_batches(_each_file(files.select("path", "archive")), run, FOUND), "arc-records")


def revisits(records: DataFrame, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """path, number and the record they refer to, of the records whose payload another one holds.

    Of equal payloads of at least ``least_bytes`` the record with the largest key is the
    response (nulls last, then by identifier); the digests of frequent payloads
    are looked up without a shuffle.
    """
    rank: Column = F.struct(F.col("key").isNotNull().alias("known"), "key", "record_id", "url", "date")
    large = records.where(F.col("payload_bytes") >= least_bytes)
    shared = large.groupBy("digest").agg(F.max(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = look_up(records, shared.select("digest", "first"), "digest")
    found = found.where((F.col("payload_bytes") >= least_bytes) & (F.col("first.record_id") != F.col("record_id")))
    return found.select("path", "number", F.col("first.record_id").alias("to_id"), F.col("first.url").alias("to_url"), F.col("first.date").alias("to_date"))


def convert(files: DataFrame, folder: str, records: DataFrame | None = None, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """Write a WARC file for each ARC file, and return the WARC files.

    A record keeps its URL, address, contents and order. Its identifier is a UUID from
    the archive's name and the record's number, so a repeated conversion gives
    the same; its date is the ARC date in ISO form; its type follows from the
    URL and the contents; block and payload digests are SHA-1. A payload that
    another record holds becomes a revisit of it with the HTTP headers alone.

    The archives are read twice: first for digests, which decide over revisits
    in narrow rows, then each ARC file meets the list of its own revisits and
    is written as WARC. Contents are never shuffled, and a task holds one record
    and one file's list. A record whose declared length passes the file's end, or a header
    line that does not fit the file's version, stops the conversion.
    """
    records = records if records is not None else scan_arc(files)
    to = F.struct("number", "to_id", "to_url", "to_date")
    lists = revisits(records, least_bytes).groupBy("path").agg(F.collect_list(to).alias("revisits"))
    work = files.select("path", "archive").join(lists, "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.to_pylist():
                refers = {r["number"]: r for r in row["revisits"] or ()}
                base = row["archive"].removesuffix(".gz").removesuffix(".arc")
                name = f"{base}-{attempt}.warc.gz"
                source, inner = file_system(row["path"])
                target, out_folder = file_system(folder)
                count = size = 0
                with source.open_input_stream(inner, compression=None) as file, target.open_output_stream(f"{out_folder}/{name}", compression=None) as out:
                    about = f"software: panelmill\r\nformat: WARC file version 1.0\r\nconverted-from: {row['archive']}\r\n".encode()
                    out.write(_warc([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(row['archive'], 0)}>"),
                        ("WARC-Date", "2001-01-01T00:00:00Z"), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ], about))
                    for r in arc_records(file):
                        data = _converted(r, row["archive"], refers.get(r.number))
                        out.write(data)
                        count, size = count + 1, size + len(data)
                yield _row([f"{folder}/{name}", name, count, size], FILES)

    work = work.repartition(min(max(1, files.count()), 20_000), "path")
    return stored(map_batches(work, run, FILES), "warc-files")


def _converted(r: ArcRecord, archive: str, to: dict | None) -> bytes:
    ip = r.fields.get("IP-address", "")
    headers = [
        ("WARC-Type", "revisit" if to else warc_type(r)),
        ("WARC-Record-ID", f"<{record_id(archive, r.number)}>"),
        ("WARC-Date", warc_date(r.fields["Archive-date"])),
        ("WARC-Target-URI", r.url),
        ("WARC-IP-Address", "" if ip in ("-", "0.0.0.0") else ip),
        ("Content-Type", "application/http; msgtype=response" if r.head else r.fields["Content-type"]),
    ]
    block = r.block
    if to:
        block = r.head
        headers += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{to['to_id']}>"),
            ("WARC-Refers-To-Target-URI", to["to_url"]), ("WARC-Refers-To-Date", to["to_date"]), ("WARC-Truncated", "length"),
        ]
    headers += [("WARC-Block-Digest", base32_sha1(block)), ("WARC-Payload-Digest", base32_sha1(r.payload))]
    return _warc(headers, block)


READ = "record_id string, record_type string, key bigint, url string, date string, payload_bytes bigint, payload_digest string, refers_to_id string"


def read_warc(files: DataFrame) -> DataFrame:
    """The records of WARC files: identifiers, type, key, and size and digest of the full payload.

    Responses are digested anew and must agree with their header; a revisit, which
    has no payload, tells both in its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in READ.split(", ")]
        kinds = [pa.int64() if "bigint" in c else pa.string() for c in READ.split(", ")]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = file_system(path)
                rows = []
                with system.open_input_stream(inner, compression=None) as file:
                    for headers, block in warc_records(file):
                        if headers["warc-type"] != "warcinfo":
                            rows.append(_described(headers, block))
                for i in range(0, len(rows), 10_000):
                    columns = zip(*rows[i:i + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return map_batches(_each_file(files.select("path")), run, READ)


def _described(headers: dict[str, str], block: bytes) -> tuple:
    head, gap, payload = block.partition(b"\r\n\r\n")
    http = {}
    if gap and headers["content-type"].startswith("application/http"):
        pairs = (h.partition(b":") for h in head.split(b"\r\n")[1:])
        http = {k.strip().lower(): v.strip() for k, _, v in pairs}
    else:
        payload = block
    told = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
    if headers["warc-type"] == "revisit":
        size = int(http[b"content-length"])
    else:
        size = len(payload)
        if hashlib.sha1(payload).digest() != told:  # noqa: S324
            raise ValueError(f"{headers['warc-record-id']}: the payload does not have its digest")
    key = http.get(KEY_HEADER.lower())
    return (
        headers["warc-record-id"].strip("<>"), headers["warc-type"], int(key) if key else None,
        headers["warc-target-uri"], headers["warc-date"], size, told.hex(),
        headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
    )


def with_referred_keys(records: DataFrame) -> DataFrame:
    """Records of ``read_warc`` with ``refers_to``, the key of the record that a revisit refers to."""
    records = stored(records, "warc-records")
    keys = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("key").alias("refers_to"))
    return look_up(records, keys, "refers_to_id")

