"""Conversion of legacy ARC archives to WARC.

Pages are first packed into ARC archives, version 1 and 2 in turn.  The converter
reads an archive by its version's own header fields and declared lengths,
synthesises WARC identifiers, dates, types and digests, and writes WARC archives,
which are then read back.  An archive is a sequence of gzip members, a record
each, stored as a binary value: one row an archive, a few MB.

Which record is the response of equal payloads is decided on a light index
(digest, page, archive, place): a partially aggregated maximum by digest, joined
back.  The decisions travel to the archives, so no payload is shuffled by digest
and a payload with very many copies is no hot key of large rows."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termite.session import scratch_path

ARCHIVE_BYTES, ARCHIVE_RECORDS = 4 << 20, 512
BROADCAST_ROWS = 1 << 19  # decisions of some 60 bytes that are sent to all tasks; more are joined by a shuffle
ADDRESS = "0.0.0.0"
DATE = "20000101000000"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Header fields of the two ARC versions (fixed values).
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _plain(data: bytes) -> bytes:
    """All gzip members of an archive."""
    out = []
    while data:
        reader = zlib.decompressobj(31)
        out.append(reader.decompress(data) + reader.flush())
        data = reader.unused_data
    return b"".join(out)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, place: int) -> str:
    """The same record gets the same identifier in every run."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{archive}#{place}").urn


# --- ARC ----------------------------------------------------------------------

class Arc(NamedTuple):
    url: str
    address: str
    date: str
    kind: str
    content: bytes


def arc_bytes(name: str, version: int, records: list[Arc]) -> bytes:
    def header(r: Arc, offset: int) -> bytes:
        url = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", r.url) or "-"
        more = [] if version == 1 else ["200", _digest(r.content), "-", str(offset), name]
        return " ".join([url, r.address, r.date, r.kind, *more, str(len(r.content))]).encode() + b"\n"

    about = f"{version} 0 origin\n{FIELDS[version]}\n".encode()
    out, offset = [], 0
    for r in [Arc(f"filedesc://{name}", ADDRESS, DATE, "text/plain", about), *records]:
        data = header(r, offset) + r.content + b"\n"
        offset += len(data)
        out.append(_member(data))
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[Arc]:
    """The records after the version block.  Its second line names the version,
    its third the fields of every header line; a record's content has the length
    its header declares, whatever it contains."""
    data, at, names = _plain(data), 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].decode().split(" ")
        if names is None:
            length = int(line[-1])
            block = data[end + 1:end + 1 + length].decode().split("\n")
            version = int(block[0].split(" ")[0])
            names = block[1].split(" ")
            if names != FIELDS[version].split(" "):
                raise ValueError(f"ARC version {version} with fields {block[1]!r}")
        else:
            if len(line) != len(names):
                raise ValueError(f"ARC header with {len(line)} fields for {len(names)}")
            field = dict(zip(names, line))
            length = int(field["Archive-length"])
            yield Arc(field["URL"], field["IP-address"], field["Archive-date"], field["Content-type"],
                      data[end + 1:end + 1 + length])
        at = end + 1 + length + 1


def http_message(page_id: int | None, payload: bytes) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n").encode() + payload


def _http_parts(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    head, _, payload = content.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, head + b"\r\n\r\n", payload


def _page(value: str | None) -> int | None:
    return int(value) if value else None


# --- WARC ---------------------------------------------------------------------

def warc_record(arc: Arc, archive: str, place: int, original: tuple | None) -> bytes:
    """A response, or a revisit of ``original`` (page id, archive, place)."""
    _, head, payload = _http_parts(arc.content)
    block = head if original else arc.content
    d = arc.date
    fields = [
        ("WARC-Type", "revisit" if original else "response"),
        ("WARC-Record-ID", f"<{record_id(archive, place)}>"),
        ("WARC-Target-URI", arc.url), ("WARC-IP-Address", arc.address),
        ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
        ("WARC-Payload-Digest", f"sha1:{_digest(payload)}"), ("WARC-Block-Digest", f"sha1:{_digest(block)}")]
    if original:
        page, *where = original
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(*where)}>"),
                   ("X-Refers-To-Page-Id", "" if page is None else str(page))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n" + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by declared length."""
    data, at = _plain(data), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *rows = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = dict(x.split(": ", 1) for x in rows)
        at = end + 4 + int(fields["Content-Length"])
        yield fields, data[end + 4:at]
        at += 4


# --- jobs ---------------------------------------------------------------------

def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_arcs(pages: DataFrame) -> DataFrame:
    """``(archive, content)``: the pages packed in the order they are read."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{n:06d}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_bytes(name, 1 + n % 2, held)], pa.binary())],
                                              names=["archive", "content"])

        for batch in parts:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url"))
            html = batch.column("html").cast(pa.binary()).to_pylist()
            for page, url, body in zip(*columns, html):
                held.append(Arc(url or "", ADDRESS, DATE, "text/html", http_message(page, body or b"")))
                size += len(held[-1].content)
                if size >= ARCHIVE_BYTES or len(held) >= ARCHIVE_RECORDS:
                    yield full()
                    n, held, size = n + 1, [], 0
        if held:
            yield full()

    return _stored(pages.select("page_id", "url", "html").mapInArrow(pack, "archive string, content binary"), "arc")


def index_arcs(arcs: DataFrame) -> DataFrame:
    """``(archive, place, page_id, n, digest)`` of each record, without payloads."""

    def index(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for name, data in zip(batch.column("archive").to_pylist(), batch.column("content")):
                rows = []
                for place, arc in enumerate(read_arc(data.as_py())):
                    fields, _, payload = _http_parts(arc.content)
                    rows.append((place, _page(fields["X-Page-Id"]), len(payload), hashlib.sha1(payload).digest()))
                place, page, n, digest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array(place, pa.int32()), pa.array(page, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(digest, pa.binary())],
                    names=["archive", "place", "page_id", "n", "digest"])

    return arcs.mapInArrow(index, "archive string, place int, page_id long, n long, digest binary")


def convert(arcs: DataFrame, least_bytes: int = 0) -> DataFrame:
    """WARC archives ``(archive, content)`` of ARC ones.  Of equal payloads of at
    least ``least_bytes`` bytes the one with the largest page id (a null one is the
    smallest; then the later record) is the response, the others revisit it."""
    records = _stored(index_arcs(arcs), "arc-index")
    groups = records.where(F.col("n") >= least_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "archive", "place")).alias("original"))
    copies = _stored(records.join(groups.where("copies > 1"), "digest").where(
        (F.col("archive") != F.col("original.archive")) | (F.col("place") != F.col("original.place"))).select(
        "archive", "place", "original"), "revisits")
    decided = copies.groupBy("archive").agg(F.collect_list(F.struct("place", "original")).alias("revisits"))
    decided = F.broadcast(decided) if copies.count() <= BROADCAST_ROWS else decided

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for name, data, revisits in zip(batch.column("archive").to_pylist(), batch.column("content"),
                                            batch.column("revisits").to_pylist()):
                original = {r["place"]: tuple(r["original"].values()) for r in revisits or []}
                content = b"".join(_member(warc_record(arc, name, place, original.get(place)))
                                   for place, arc in enumerate(read_arc(data.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([name[:-3] + "warc"]), pa.array([content], pa.binary())],
                                                 names=["archive", "content"])

    return _stored(arcs.join(decided, "archive", "left").mapInArrow(work, "archive string, content binary"), "warc")


def read_warcs(warcs: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url,
    record_id)`` of each record; a response's payload is checked against its
    digest.  A revisit has no payload; its size is the stored message's length."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id"]
        for batch in parts:
            for data in batch.column("content"):
                rows = []
                for fields, block in read_warc(data.as_py()):
                    http, _, payload = _http_parts(block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and _digest(payload) != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    rows.append((_page(http["X-Page-Id"]), int(http["Content-Length"]), digest, fields["WARC-Type"],
                                 _page(fields.get("X-Refers-To-Page-Id")), fields["WARC-Target-URI"], fields["WARC-Record-ID"]))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return warcs.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, url string, record_id string")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back, a row each.  A null
    page is an empty payload, a null URL is written as ``-``; repeated rows revisit
    one of them; an empty table gives an empty result.  Only ``page_id``, ``url``
    and ``html`` are read."""
    return read_warcs(convert(write_arcs(pages)))
