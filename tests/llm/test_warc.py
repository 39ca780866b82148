from __future__ import annotations

import gzip
import hashlib

import pytest

from loomstat.llm import warc
from loomstat.session import new_path

SCHEMA = "page_id bigint, url string, html string, payload string, size int"


def pages():
    big = "<p>same payload é</p>" * 60
    rows = [(i, f"http://a.example/{i}?q=ü x", f"<html>{'y' * (i * 37)}é{i}</html>") for i in range(80)]
    rows += [(200 + i, f"http://b.example/{i}", big) for i in range(30)]
    rows += [(300, "http://c", "small"), (301, "http://c", "small"), (302, None, None), (303, "", ""), (None, "n", big), (None, "n", None)]
    tricky = "\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\nhttp://x 1 2 3 4\nfiledesc:\n" * 20
    rows += [(304, "http://t\n x", tricky), (305, "http://t", tricky), (306, "long", "z" * 3_000_000), (229, "http://again", big)]
    return rows


def want(rows, least):
    keeper = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= least:
            keeper[html] = max(keeper.get(html, -1), -1 if page is None else page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        top = keeper.get(html)
        revisit = top is not None and page != top
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    rows = pages()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    found = warc.read_warc(spark, warc.convert(docs, version=version)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == want(rows, 1000)
    html = {p: (h or "").encode() for p, _, h in rows}
    by_id = {r.record_id: r for r in found}
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None and r.page_id is not None:
            assert bytes(r.payload) == html[r.page_id]
        if r.record_type == "revisit":
            assert by_id[r.refers_to_id].page_id == r.refers_to
        assert r.date == "2020-01-01T00:00:00Z" and "\n" not in r.uri and " " not in r.uri


def test_legacy_files(spark, tmp_path):
    """Files that others wrote: plain or packed record by record, both versions, no HTTP block, short dates."""
    one = b"1 0 Old\nURL IP-address Archive-date Content-type Archive-length\n"
    head = b"filedesc://x.arc 0.0.0.0 19961212 text/plain %d\n" % len(one)
    first = b"http://h/ 1.2.3.4 199612 text/html 9\n<b>\n\n</b>\n"
    second = b"http://k/ 1.2.3.4 19970101112233 text/html 40\nHTTP/1.0 404 No\nContent-Type: text/html\n\nno\n"
    second = second.replace(b" 40\n", b" %d\n" % len(b"HTTP/1.0 404 No\nContent-Type: text/html\n\nno"))
    (tmp_path / "a.arc").write_bytes(head + one + b"\n" + first + second)
    two = b"2 0 New\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    head = b"filedesc://y.arc 0.0.0.0 1998 text/plain 200 - - 0 y.arc %d\n" % len(two)
    third = b"http://m/ 5.6.7.8 19980303 text/html 301 abc - 99 y.arc 2\nhi\n"
    (tmp_path / "b.arc.gz").write_bytes(gzip.compress(head + two + b"\n") + gzip.compress(third))
    rows = {r.uri: r for r in warc.read_arc(spark, str(tmp_path)).collect()}
    assert bytes(rows["http://h/"].payload) == b"<b>\n\n</b>" and rows["http://h/"].status is None
    assert bytes(rows["http://k/"].payload) == b"no" and rows["http://k/"].status == 404
    assert bytes(rows["http://m/"].payload) == b"hi" and rows["http://m/"].status == 301
    assert warc.w3c_date(rows["http://h/"].stamp) == "1996-12-01T00:00:00Z"
    out = new_path(spark, "warc-test")
    warc.to_warc(warc.read_arc(spark, str(tmp_path)), out)
    assert sorted(r.date for r in warc.read_warc(spark, out).collect()) == [
        "1996-12-01T00:00:00Z", "1997-01-01T11:22:33Z", "1998-03-03T00:00:00Z"]


def test_damaged_files_are_not_passed_over():
    with pytest.raises(ValueError, match="ends within"):
        list(warc.arc_records(b"filedesc://x 0 1 t 99\n1 0 x\n"))
    with pytest.raises(ValueError, match="not known"):
        list(warc.arc_records(b"filedesc://x 0 1 t 6\n7 0 x\n"))
    with pytest.raises(ValueError, match="begins with"):
        list(warc.warc_records(b"nonsense\n"))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert warc.read_warc(spark, warc.convert(docs)).collect() == []
