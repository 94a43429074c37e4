import base64
import hashlib
import io

import pytest

from gridmart.llm import arc

SCHEMA = "page_id long, url string, html string, payload string"


def records(*parts):
    return list(arc.read_arc(io.BytesIO(b"".join(p + b"\n" for p in parts))))


@pytest.mark.parametrize("version", [1, 2])
def test_versions_are_read_by_their_fields(version):
    tricky = b"a\nhttp://b/ 0.0.0.0 19990101000000 text/html 3\nabc\r\n\r\n"
    found = records(
        arc.version_block(version, "x.arc"),
        arc.arc_record(version, 7, "http://a.example/ü b", tricky),
        arc.arc_record(version, None, None, b""),
    )
    assert [arc.split_http(block)[1] for _, block in found[1:]] == [tricky, b""]
    assert found[1][0]["URL"] == "http://a.example/%C3%BC%20b"
    assert tuple(found[1][0]) == arc.ARC_VERSIONS[version]


def test_old_blanks_in_urls_broken_lines_and_cut_records():
    head = arc.version_block(1, "x.arc")
    line = b"http://a/b c 1.2.3.4 19970203 text/plain 5\nhello"
    found = records(head, b"not a record", line, b"http://cut/ 1.2.3.4 19970203 text/plain 500\nshort")
    assert [(f["URL"], b.rstrip(b"\n")) for f, b in found[1:]] == [("http://a/b c", b"hello"), ("http://cut/", b"short")]


def test_equivalent_warc_record():
    (_, _), (fields, block) = records(
        arc.version_block(1, "x.arc"), b"dns:a.example 1.2.3.4 19970203040506 text/dns 5\nhello"
    )
    raw = arc.warc_record(fields, block)
    assert raw == arc.warc_record(fields, block)
    ((headers, body),) = arc.read_warc(io.BytesIO(raw + b"\r\n\r\n"))
    assert body == b"hello"
    assert headers["warc-type"] == "resource"
    assert headers["warc-date"] == "1997-02-03T04:05:06Z"
    digest = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    assert headers["warc-block-digest"] == headers["warc-payload-digest"] == f"sha1:{digest}"
    assert arc.warc_date("1997") == "1997-01-01T00:00:00Z"


def test_rows_in_every_state(spark):
    long = "é\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [
        (3, "http://a/", "same", ""),
        (1, "http://b/", "same", ""),
        (2, None, None, ""),
        (5, "http://c/ \n", "", ""),
        (6, "http://d/", long, ""),
        (6, "http://d/", long, ""),
        (None, "http://e/", "same", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = arc.archive_pages(frame).collect()
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found]
    size = len(long.encode())
    expected = [
        (3, "revisit", 1, 4),
        (1, "response", None, 4),
        (2, "response", None, 0),
        (5, "revisit", 2, 0),
        (6, "response", None, size),
        (6, "response", None, size),
        (None, "revisit", 1, 4),
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {bytes(r["payload"]) for r in found if r["page_id"] == 6} == {long.encode()}
    assert {r["record_type"] for r in arc.archive_pages(frame, min_bytes=10**9).collect()} == {"response"}
    assert arc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_more_records_than_a_file_takes(spark, monkeypatch):
    rows = [(i, f"http://a/{i}", f"page {i % 1500}", "") for i in range(2500)]
    found = arc.archive_pages(spark.createDataFrame(rows, SCHEMA).coalesce(1), payloads=False).collect()
    assert {r["page_id"]: r["refers_to"] for r in found} == {i: i - 1500 if i >= 1500 else None for i in range(2500)}
