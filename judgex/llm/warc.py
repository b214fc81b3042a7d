"""Legacy archive converter: ARC files (versions 1 and 2) to WARC 1.1, with revisits, and readers for both.

An ARC file begins with a version block, whose own header ends with its length; its first line gives the version and so
the fields of all later header lines. Lengths are declared, so records are cut by length and never searched for.
Each record becomes a WARC record with a synthesised identifier (a UUID from archive name and record number), the
date as an ISO timestamp, the type, and SHA-1 digests in base 32. Of records with equal payloads the one with the largest
page id is the response and the others revisit it.

Archives hold at most ``ARCHIVE_BYTES`` of records (or one longer record) and are written by Spark's own text sink, a row a
file, so they go to any file system Spark writes to. Records are gzip members, as is usual for .arc.gz and .warc.gz; the
sink's line end supplies the last byte of a closing empty member, so the files are plain multi-member gzip (though
their names end with .txt).

Defined results: null html is an empty payload; a null url is written as "-"; white space and control characters in urls
are percent-encoded in header lines; rows with a repeated page_id are records of their own, and among equal
payloads with equal largest page_id exactly one is the response; null page_ids count as least; a declared length beyond
the end gives a record marked as truncated; header lines that can't be parsed are skipped; an empty table gives an
empty result; further columns are ignored.
"""

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
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm.arrow import over, table
from judgex.session import cut, release, scratch

ARCHIVE_BYTES = 4 << 20
#: The fields of header lines by ARC version, and what the version block says of them.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID_HEADER = b"X-Page-Id: "
_LEVEL = 3


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: An empty member ends with eight zero bytes; the sink's line end is the last of them.
_CLOSING, _LAST = _member(b"")[:-1], "\0"
assert _member(b"").endswith(b"\0")


def unpacked(content: bytes) -> bytes:
    """An archive's bytes: of any number of gzip members, or as they are."""
    out = []
    while content[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        out.append(z.decompress(content))
        content = z.unused_data
    return b"".join(out) if out else content


def _write(archives: DataFrame, path: str) -> None:
    """Each row's ``content`` becomes a file."""
    archives.select(F.col("content").cast("string").alias("value")).write.option("lineSep", _LAST).option("maxRecordsPerFile", 1).text(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _packed(records: Iterator[bytes], head, name: str) -> Iterator[tuple[str, bytes]]:
    """(name, content) of archives of bounded size; ``head(name)`` begins each."""
    buf, held, seq = [], 0, 0
    for r in records:
        if not buf:
            own = f"{name}-{seq:06d}"
            buf = [_member(head(own))]
        buf.append(_member(r))
        held += len(r)
        if held >= ARCHIVE_BYTES:
            yield own, b"".join(buf) + _CLOSING
            buf, held, seq = [], 0, seq + 1
    if buf:
        yield own, b"".join(buf) + _CLOSING


# ARC


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


def arc_head(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 judgex\n{ARC_FIELDS[version]}\n"
    mid = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {mid}{len(body)}\n{body}\n".encode()


def arc_record(version: int, name: str, url: str | None, date: str, content: bytes) -> bytes:
    mid = "" if version == 1 else f"200 {hashlib.md5(content).hexdigest()} - 0 {name} "
    return f"{_url(url)} 0.0.0.0 {date} text/html {mid}{len(content)}\n".encode() + content + b"\n"


class ArcRecord(NamedTuple):
    name: str
    number: int
    url: str
    ip: str
    date: str
    kind: str
    content: bytes
    truncated: bool


def arc_records(content: bytes, fallback: str = "archive") -> Iterator[ArcRecord]:
    """The records of an ARC file but its version block."""
    data, at, version, name, number = unpacked(content), 0, 1, fallback, 0
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        at = end + 1
        if not line:
            continue
        head = line.startswith("filedesc://")
        parts = line.rsplit(" ", 1 if head else ARC_FIELDS[version].count(" "))
        if not parts[-1].isdecimal() or len(parts) < 2:
            continue
        size = int(parts[-1])
        body, truncated = data[at : at + size], at + size > len(data)
        at += size
        if head:
            name = line.split(" ", 1)[0].removeprefix("filedesc://") or fallback
            said = body.split(b" ", 1)[0]
            version = int(said) if said.isdigit() and int(said) in ARC_FIELDS else 1
        elif len(parts) == ARC_FIELDS[version].count(" ") + 1:
            yield ArcRecord(name, number, *parts[:4], body, truncated)
            number += 1


def write_arc(pages: DataFrame, path: str, version: int | None = None, date: str = "20240101000000") -> None:
    """Pages (page_id, url, html) as ARC files of HTTP responses; without a version, partitions take 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        v = version or 1 + part % 2

        def records() -> Iterator[bytes]:
            for b in batches:
                for page_id, url, html in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    own = b"" if page_id is None else _ID_HEADER + str(page_id).encode() + b"\r\n"
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + b"\r\n"
                    yield arc_record(v, name, url, date, http + (html or "").encode())

        name = f"judgex-{part:06d}"
        for _, content in _packed(records(), lambda n: arc_head(v, n, date), name):
            yield table(content=pa.array([content], pa.binary()))

    from judgex.llm.arrow import batched

    _write(batched(pages.select(pages["page_id"].cast("long"), "url", "html")).mapInArrow(run, "content binary"), path)


# WARC


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str, number: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{name}#{number}'.encode()).digest()[:16], version=5)}>"


def iso_date(date: str) -> str:
    """ARC's 14 digits as a WARC timestamp; shorter ones are filled up."""
    d = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)) :])[:14] if date else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(content: bytes) -> tuple[bytes, bytes] | None:
    """(header with its empty line, payload) of an HTTP response, or None."""
    if not content.startswith(b"HTTP/"):
        return None
    m = re.search(rb"\r?\n\r?\n", content)
    return (content[: m.end()], content[m.end() :]) if m else (content, b"")


def page_id_of(http_head: bytes) -> int | None:
    m = re.search(rb"^X-Page-Id: (-?\d+)\r?$", http_head, re.M)
    return int(m[1]) if m else None


def _warc(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def warc_head(name: str, date: str) -> bytes:
    return _warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, -1)), ("WARC-Date", iso_date(date)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"software: judgex\r\nformat: WARC File Format 1.1\r\n")


def converted(r: ArcRecord, of: tuple[int | None, str, int] | None) -> bytes:
    """The WARC record of an ARC record; ``of`` is (page id, archive, number) of the response that it revisits."""
    http = split_http(r.content)
    head, payload = http or (b"", r.content)
    fields = [
        ("WARC-Type", "revisit" if of else "response" if http else "resource"), ("WARC-Record-ID", record_id(r.name, r.number)), ("WARC-Date", iso_date(r.date)),
        ("WARC-Target-URI", r.url), ("Content-Type", "application/http; msgtype=response" if http else r.kind), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("X-Payload-Length", str(len(payload))),
    ]
    if r.ip not in ("", "-", "0.0.0.0"):
        fields.append(("WARC-IP-Address", r.ip))
    if r.truncated:
        fields.append(("WARC-Truncated", "unspecified"))
    block = r.content
    if of:
        block = head
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(of[1], of[2]))] + [("X-Refers-To-Page-Id", str(of[0]))] * (of[0] is not None)
    return _warc([*fields, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")], block)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record of a WARC file."""
    data, at = unpacked(content), 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def _digests(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
        rows = []
        for r in arc_records(content, path.rsplit("/", 1)[-1]):
            head, payload = split_http(r.content) or (b"", r.content)
            rows.append((path, r.name, r.number, page_id_of(head), len(payload), hashlib.sha1(payload).digest()))
        if rows:
            c = list(zip(*rows))
            yield table(path=list(c[0]), name=list(c[1]), number=pa.array(c[2], pa.int32()), page_id=pa.array(c[3], pa.int64()), n=pa.array(c[4], pa.int64()), sha=pa.array(c[5], pa.binary()))


def convert(spark: SparkSession, arc: str, warc: str, least: int = 0) -> None:
    """Convert the ARC files in folder ``arc`` to WARC files in folder ``warc``; payloads of ``least`` bytes revisit."""
    seen = cut(over(_read(spark, arc), _digests, "path string, name string, number int, page_id long, n long, sha binary"), "arc-digests")
    tops = seen.filter(F.col("n") >= least).groupBy("sha", "n").agg(F.max(F.struct("page_id", "path", "number", "name")).alias("top"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    again = seen.join(tops, ["sha", "n"]).filter("path != top.path or number != top.number")
    plan = again.groupBy("path").agg(F.collect_list(F.struct("number", F.col("top.page_id").alias("page_id"), F.col("top.name").alias("name"), F.col("top.number").alias("of"))).alias("plan"))
    rows = _read(spark, arc).join(plan, "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content, plan in zip(*(b.column(c).to_pylist() for c in ("path", "content", "plan"))):
                of = {x["number"]: (x["page_id"], x["name"], x["of"]) for x in plan or []}
                first = next(arc_records(content), None)
                if first is None:
                    continue
                records = (converted(r, of.get(r.number)) for r in arc_records(content, path.rsplit("/", 1)[-1]))
                for _, out in _packed(records, lambda n: warc_head(n, first.date), first.name):
                    yield table(content=pa.array([out], pa.binary()))

    from judgex.llm.arrow import batched

    _write(batched(rows).mapInArrow(run, "content binary"), warc)


def read_warc(spark: SparkSession, warc: str) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, date) of the archives in a folder."""

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for content in b.column("content").to_pylist():
            rows = []
            for w, block in warc_records(content):
                if w["warc-type"] == "warcinfo":
                    continue
                head, payload = split_http(block) or (b"", block)
                digest = w["warc-payload-digest"].removeprefix("sha1:")
                if w["warc-type"] != "revisit" and digest != base32_sha1(payload):
                    raise ValueError(f"payload of {w['warc-record-id']} doesn't have its digest")
                to = w.get("x-refers-to-page-id")
                rows.append((page_id_of(head), int(w["x-payload-length"]), digest, w["warc-type"], int(to) if to else None, w["warc-record-id"], w["warc-target-uri"], w["warc-date"]))
            if rows:
                c = list(zip(*rows))
                yield table(page_id=pa.array(c[0], pa.int64()), payload_bytes=pa.array(c[1], pa.int64()), payload_digest=list(c[2]), record_type=list(c[3]), refers_to=pa.array(c[4], pa.int64()), record_id=list(c[5]), url=list(c[6]), date=list(c[7]))

    return over(_read(spark, warc), f, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, date string")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    convert(spark, arc, warc)
    release(spark)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, unhex(sha1(html))::BIT::VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY html) AS top FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
           + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""
