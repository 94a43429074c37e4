"""Legacy web archives (ARC, versions 1 and 2) turned into WARC, and both read and written on Spark.

An ARC file opens with a version block that names the fields of every later header line; a record is
a header line, a document of the declared length and a line end. Version 1 knows five fields,
version 2 ten. A record with declared length is read by that length, never by looking for the next
header.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged
from gridmart.session import scratch_path

#: What the version blocks of both ARC versions say, and the names of the fields.
ARC_VERSIONS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one archive file; bounds what is held at once when archives are read whole.
RECORDS_PER_FILE = 1000
_PAGE = b"x-page-id"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------------


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 gridmart\n{' '.join(ARC_VERSIONS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "Content-type": "text/plain", "Filename": name}
    return _header_line(version, values, len(body)) + body


def _header_line(version: int, values: dict[str, str], length: int) -> bytes:
    known = {"IP-address": "0.0.0.0", "Archive-date": "19960101000000", "Offset": "0"} | values
    known["Archive-length"] = str(length)
    return (" ".join(known.get(name, "-") for name in ARC_VERSIONS[version]) + "\n").encode()


def arc_record(version: int, page_id: int | None, url: str | None, html: bytes) -> bytes:
    """One page as an archived HTTP response; the page's number travels as an HTTP header."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n"
    if page_id is not None:
        head += f"X-Page-Id: {page_id}\r\n"
    block = head.encode() + b"\r\n" + html
    moment = datetime(1996, 1, 1, tzinfo=UTC) + timedelta(seconds=(page_id or 0) % 10**8)
    values = {
        "URL": quote(url or "-", safe="/:?#[]@!$&'()*+,;=%~"),
        "Archive-date": moment.strftime("%Y%m%d%H%M%S"),
        "Content-type": "text/html",
        "Result-code": "200",
    }
    return _header_line(version, values, len(block)) + block


def read_arc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, document) of every record, the version block included.

    The field list of the version block holds until the next one. Header lines are split from
    the right, since old crawlers left blanks in URLs. A line that does not give the fields or
    a length is skipped; a document cut short by the end of the file is given as far as it goes.
    """
    names = ARC_VERSIONS[1]
    while line := stream.readline():
        parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if parts[0].startswith("filedesc://"):
            whole = line.decode("utf-8", "replace").split()
            names = ARC_VERSIONS[2] if len(whole) >= len(ARC_VERSIONS[2]) else ARC_VERSIONS[1]
            parts = whole
        if len(parts) != len(names) or not parts[-1].isdigit():
            continue
        fields = dict(zip(names, parts, strict=True))
        document = stream.read(int(fields["Archive-length"]))
        if fields["URL"].startswith("filedesc://"):
            said = document.decode("utf-8", "replace").split("\n")
            if len(said) > 1 and said[1].split()[-1:] == ["Archive-length"]:
                names = tuple(said[1].split())
        yield fields, document


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its empty line) and payload; all payload where there is no head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, found, payload = block.partition(b"\r\n\r\n")
    return (head + found, payload) if found else (block, b"")


def http_header(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode()
    return None


# --- WARC --------------------------------------------------------------------------------------


def warc_date(arc_date: str) -> str:
    """14 digits as a WARC timestamp; shorter dates mean the start of what they name."""
    digits = "".join(c for c in arc_date if c.isdigit())[:14]
    filled = digits + "19960101000000"[len(digits) :]
    return f"{filled[:4]}-{filled[4:6]}-{filled[6:8]}T{filled[8:10]}:{filled[10:12]}:{filled[12:]}Z"


def warc_record(fields: dict[str, str], block: bytes, refers_to: int | None = None) -> bytes:
    """The WARC record equivalent to an ARC record, up to the line ends that close it.

    The identifier follows from the record's content, so a repeated conversion gives it again.
    ``refers_to`` makes it a revisit of that page: the HTTP head stays, the payload goes.
    """
    head, payload = split_http(block)
    digest = payload_digest(payload)
    scheme = fields["URL"].partition(":")[0].lower()
    kind = {"filedesc": "warcinfo", "http": "response", "https": "response"}.get(scheme, "resource")
    if head:
        kind = "response"
    page = http_header(head, _PAGE)
    name = "|".join((fields["URL"], fields["Archive-date"], digest, page or ""))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"WARC-Date: {warc_date(fields['Archive-date'])}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind != "warcinfo":
        lines += [f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Page: {refers_to}"]
        block = head
    lines.append(
        "Content-Type: " + ("application/http; msgtype=response" if head else fields["Content-type"])
    )
    lines.append(f"WARC-Block-Digest: sha1:{payload_digest(block)}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record, read by its declared length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


# --- on Spark ----------------------------------------------------------------------------------


def _write(records: DataFrame, path: str, end: str) -> None:
    """Records (one binary column) as gzip files, each record followed by ``end``."""
    text = records.select(F.col(records.columns[0]).cast("string").alias("value"))
    writer = text.write.option("lineSep", end).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _archives(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _opened(content: bytes) -> BinaryIO:
    return gzip.GzipFile(fileobj=io.BytesIO(content))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, rows_held: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == rows_held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_VALUE = pa.schema([("value", pa.binary())])


def _headed(rows: Iterator[bytes], opening: Callable[[int], bytes]) -> Iterator[tuple[bytes]]:
    """An opening record before the first of every ``RECORDS_PER_FILE - 1`` rows: each file has one."""
    for k, row in enumerate(rows):
        if k % (RECORDS_PER_FILE - 1) == 0:
            yield (opening(k),)
        yield (row,)


def write_arc(pages: DataFrame, path: str) -> None:
    """``pages`` (page_id, url, html) as legacy archives below ``path``, of either version by turns.

    No row moves: each task writes what it reads. Null html is an empty payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version = 1 + part % 2

        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield arc_record(version, page_id, url, html or b"")

        yield from _in_batches(_headed(records(), lambda k: version_block(version, f"{part}-{k}.arc")), _VALUE)

    columns = ("page_id", "url", F.col("html").cast("binary"))
    _write(pages.select(*columns).mapInArrow(run, "value binary"), path, "\n")


_FOUND = pa.schema(
    [("path", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64())]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                for at, (fields, block) in enumerate(read_arc(_opened(content.as_py()))):
                    if fields["URL"].startswith("filedesc://"):
                        continue
                    head, payload = split_http(block)
                    page = http_header(head, _PAGE)
                    yield path, at, page and int(page), payload_digest(payload), len(payload)

    yield from _in_batches(rows(), _FOUND, 4096)


def _converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        for batch in batches:
            for content, revisits in zip(batch["content"], batch["revisits"].to_pylist(), strict=True):
                target = {r["at"]: r["first"] for r in revisits or ()}
                for at, (fields, block) in enumerate(read_arc(_opened(content.as_py()))):
                    if not fields["URL"].startswith("filedesc://"):
                        yield warc_record(fields, block, target.get(at))

    def opening(k: int) -> bytes:
        fields = {"URL": "filedesc://converted.arc", "Archive-date": "", "Content-type": "application/warc-fields"}
        return warc_record(fields, b"software: gridmart\r\nformat: WARC file version 1.1\r\n")

    yield from _in_batches(_headed(records(), opening), _VALUE)


def convert(spark, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """The archives below ``arc_path`` as WARC files below ``warc_path``.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest page
    number is a response and the others revisit it; records without a number only revisit. Only
    digests are grouped; the payloads move once, as whole compressed archives.
    """
    found = staged(_archives(spark, arc_path).mapInArrow(_digests, _ddl(_FOUND)), "arc-digests")
    shared = found.filter(F.col("bytes") >= min_bytes).groupBy("digest")
    first = staged(shared.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "arc-first")
    later = found.filter(F.col("bytes") >= min_bytes).join(first.select("digest", "first"), "digest")
    later = later.filter(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    by_file = later.groupBy("path").agg(F.collect_list(F.struct("at", "first")).alias("revisits"))
    ready = _archives(spark, arc_path).join(by_file, "path", "left").select("content", "revisits")
    _write(ready.mapInArrow(_converted, "value binary"), warc_path, "\r\n\r\n")


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("warc_date", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(spark, warc_path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the WARC files below ``warc_path``, without the warcinfo records.

    A response's length and digest are taken from its payload, a revisit's from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch["content"]:
                    for headers, block in read_warc(_opened(content.as_py())):
                        if headers["warc-type"] != "warcinfo":
                            yield _row(headers, block, payloads)

        yield from _in_batches(rows(), _READ, 64)

    return _archives(spark, warc_path).select("content").mapInArrow(run, _ddl(_READ))


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, payload = split_http(block)
    page, target = http_header(head, _PAGE), headers.get("warc-refers-to-page")
    revisit = headers["warc-type"] == "revisit"
    return (
        page and int(page),
        headers.get("warc-target-uri"),
        headers["warc-type"],
        headers["warc-record-id"],
        headers["warc-date"],
        int(http_header(head, b"content-length") or 0) if revisit else len(payload),
        headers["warc-payload-digest"].removeprefix("sha1:") if revisit else payload_digest(payload),
        target and int(target),
        payload if payloads and not revisit else None,
    )


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def archive_pages(pages: DataFrame, min_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """``pages`` through legacy archives and their conversion, read back from the WARC files.

    The files stay in the shared folder. No pages give no records; repeated rows give a record each.
    """
    spark = pages.sparkSession
    legacy, modern = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, legacy)
    convert(spark, legacy, modern, min_bytes)
    return read_archives(spark, modern, payloads)
