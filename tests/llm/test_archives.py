"""ARC and WARC round trips, and the choice of responses."""

import base64
import hashlib

import pytest

from small import tuples
from termite.llm import archives as A

PAGES = "page_id long, url string, html string"


def brute(rows):
    of = {}
    for page, _, html in rows:
        of.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        best = max(of[html or ""], key=lambda x: -1 if x is None else x)
        data = (html or "").encode()
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if page == best else "revisit", None if page == best else best))
    return sorted(out, key=repr)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    records = [A.Arc("http://h/a b\n", A.ADDRESS, A.DATE, "text/html", A.http_message(7, "x\r\n\r\n1 0 origin\n é".encode())),
               A.Arc("", A.ADDRESS, "19991231235959", "text/html", A.http_message(None, b""))]
    got = list(A.read_arc(A.arc_bytes("n.arc", version, records)))
    assert [r.content for r in got] == [r.content for r in records]
    assert [r.url for r in got] == ["http://h/a%20b%0A", "-"] and got[1].date == "19991231235959"
    warc = A._member(A.warc_record(got[0], "n.arc", 0, None)) + A._member(A.warc_record(got[1], "n.arc", 1, (7, "n.arc", 0)))
    (first, block), (second, head) = A.read_warc(warc)
    assert block == records[0].content and first["WARC-Type"] == "response"
    assert second["WARC-Date"] == "1999-12-31T23:59:59Z" and second["WARC-Refers-To"] == first["WARC-Record-ID"]
    assert head.endswith(b"\r\n\r\n") and second["Content-Length"] == str(len(head))


def test_unknown_fields_are_refused():
    bad = A._member(b"filedesc://n 0.0.0.0 20000101000000 text/plain 15\n1 0 origin\nURL\n\n")
    with pytest.raises(ValueError):
        list(A.read_arc(bad))


def test_pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 7}</p>" * (1 + i % 3)) for i in range(90)]
    rows += [(200, None, None), (201, "http://h/é", ""), (202, "u", "né\r\n\r\nx"), (203, "u", "x" * 5_000_000), (204, "u", None)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 archive", "2 place", "3 digest", "4 n")
    got = A.archive_pages(df)
    assert tuples(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "u", "same"), (None, "u", "alone")]
    got = A.archive_pages(spark.createDataFrame(rows, PAGES)).collect()
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got if r.payload_bytes == 4)
    assert kinds == [("1", "response", None), ("1", "revisit", 1), ("None", "revisit", 1)]
    assert [r.record_type for r in got if r.payload_bytes == 5] == ["response"]
    assert A.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_are_no_revisits(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = A.read_warcs(A.convert(A.write_arcs(spark.createDataFrame(rows, PAGES)), least_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
