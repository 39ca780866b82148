"""Legacy archive converter: ARC files, versions 1 and 2, to WARC files, and WARC files back to rows.

``write_arc`` lays pages down as a legacy crawler would have: a version block, then records with a header line and a
declared length. ``read_arc`` parses header lines by the version that the file declares and takes each block by its
declared length, whatever bytes it holds. ``to_warc`` synthesises what WARC wants and ARC lacks: record identifiers
(from address, place and date, the same in every run), W3C time stamps, types and SHA-1 digests; of equal payloads of at
least ``revisit_bytes`` that of the largest page is a response and the others refer to it. ``read_warc`` reads records
by their lengths and checks each payload against its digest.

Files are written by Spark's text writer, one per task, compressed, so their sizes follow the splits of the input, and
are read whole files at a time but unpacked piece by piece.

Defined cases: a null payload is empty; a null or odd address is written in percent codes, null as ``about:blank``. Of
rows that share the largest page among equal payloads each is a response. A null page counts as the smallest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm.common import durable, new_path, slices, utf8

# Field names of the two versions' header lines, as the version blocks declare them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_BYTES = 1000
# ARC version of the files, and the date and address of the records written for pages that have neither.
DATE, ADDRESS = "20200101000000", "0.0.0.0"
SPACE = uuid.UUID("5bb1a6f5-4d1f-4c6c-9c39-8a2c1d2e7f10")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
# Archives are written once and read once or twice: the fastest level costs some size and saves most of the time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
RECORD = "page_id bigint, uri string, ip string, stamp string, mime string, status int, offset bigint, payload binary"


def _uri(url: bytes | None) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]-._") if url else "about:blank"


def _http(page: int | None, size: int) -> bytes:
    name = b"" if page is None else b"X-Page-Id: %d\r\n" % page
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + name + b"Content-Length: %d\r\n\r\n" % size


def _arc_records(version: int):
    """One text line per record: the writer ends each with the newline that separates ARC records."""

    def run(batches):
        fields = ARC_FIELDS[version]
        block = f"{version} 0 archive\n{fields}\n"
        spare = " 200 - - 0 archive.arc" if version == 2 else ""
        head = f"filedesc://archive.arc {ADDRESS} {DATE} text/plain{spare} {len(block)}\n{block}"
        offset = len(head) + 1
        first = True
        for batch in slices(batches):
            out = [head] if first else []
            first = False
            for page, url, html in zip(batch.column("page").to_pylist(), utf8(batch.column("url")), utf8(batch.column("html"))):
                content = _http(page, len(html or b"")) + (html or b"")
                more = f" 200 - - {offset} archive.arc" if version == 2 else ""
                line = f"{_uri(url)} {ADDRESS} {DATE} text/html{more} {len(content)}\n".encode()
                offset += len(line) + len(content) + 1
                out.append((line + content).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    return run


def write_arc(
    pages: DataFrame, path: str, *, version: int = 1, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """Pages as ARC files below ``path``, one per task."""
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    lines = rows.mapInArrow(_arc_records(version), "value string")
    lines.write.options(**GZIP).option("lineSep", "\n").text(path)


class _Unpacked:
    """Bytes of a compressed or plain file, unpacked as they are asked for."""

    def __init__(self, content: bytes):
        self.content, self.at = memoryview(content), 0
        self.unpack = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.ready = bytearray()
        self.taken = 0

    def _more(self) -> bool:
        if self.unpack is None or self.unpack.eof:
            rest = self.unpack.unused_data if self.unpack else b""
            if self.unpack and (rest or self.at < len(self.content)):
                # Another member: archives may be compressed record by record.
                self.unpack = zlib.decompressobj(31)
                self.ready += self.unpack.decompress(rest, CHUNK) if rest else b""
                if rest:
                    return True
            elif self.unpack:
                return False
        if self.unpack is not None and self.unpack.unconsumed_tail:
            self.ready += self.unpack.decompress(self.unpack.unconsumed_tail, CHUNK)
            return True
        part = bytes(self.content[self.at:self.at + CHUNK])
        self.at += len(part)
        if part:
            self.ready += self.unpack.decompress(part, CHUNK) if self.unpack else part
        return bool(part)

    def _take(self, n: int) -> bytes:
        out = bytes(self.ready[:n])
        del self.ready[:n]
        self.taken += len(out)
        return out

    def read(self, n: int) -> bytes:
        while len(self.ready) < n and self._more():
            pass
        if len(self.ready) < n:
            raise ValueError(f"the archive ends within a record: {n} bytes declared, {len(self.ready)} there")
        return self._take(n)

    def line(self) -> bytes:
        """Up to and with the next newline; what is left at the end of the file."""
        seen = 0
        while (found := self.ready.find(b"\n", seen)) < 0:
            seen = len(self.ready)
            if not self._more():
                return self._take(len(self.ready))
        return self._take(found + 1)


def _split_http(content: bytes) -> tuple[dict[str, str], int | None, bytes]:
    """Header fields, status and body of an HTTP response; content without one is all body."""
    if not content.startswith(b"HTTP/"):
        return {}, None, content
    end = re.search(rb"\r?\n\r?\n", content)
    head, body = (content[:end.start()], content[end.end():]) if end else (content, b"")
    lines = head.decode("latin-1").splitlines()
    status = re.search(r"\s(\d{3})", lines[0])
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]))
    return fields, int(status[1]) if status else None, body


def arc_records(content: bytes):
    """``(header fields, offset, block)`` of every record of an ARC file but its version block."""
    source = _Unpacked(content)
    names: list[str] = []
    while True:
        offset = source.taken
        line = source.line()
        if not line:
            return
        if not line.strip():
            continue
        values = line.decode("latin-1").rstrip("\r\n").split(" ")
        if line.startswith(b"filedesc:"):
            block = source.read(int(values[-1])).decode("latin-1").split("\n")
            version = int(block[0].split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            names = block[1].split(" ") if len(block) > 1 and block[1] else ARC_FIELDS[version].split(" ")
            continue
        if len(values) != len(names):
            raise ValueError(f"a header line of {len(values)} fields where the file declares {len(names)}: {line[:200]!r}")
        fields = dict(zip(names, values))
        yield fields, offset, source.read(int(fields["Archive-length"]))


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _in_parts(rows, schema: pa.Schema, size: int = 8 << 20):
    """Record batches of some ``size`` bytes."""
    held, total = [], 0
    for row, weight in rows:
        held.append(row)
        total += weight
        if total >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ARC files: page, address, IP, 14-digit date, type, status, offset and payload."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("uri", pa.string()), ("ip", pa.string()), ("stamp", pa.string()), ("mime", pa.string()),
        ("status", pa.int32()), ("offset", pa.int64()), ("payload", pa.binary()),
    ])

    def rows(content):
        for fields, offset, block in arc_records(content):
            http, status, body = _split_http(block)
            page = http.get("x-page-id")
            code = fields.get("Result-code")
            yield {
                "page_id": int(page) if page else None, "uri": fields["URL"], "ip": fields["IP-address"],
                "stamp": fields["Archive-date"], "mime": fields["Content-type"],
                "status": int(code) if code and code.isdigit() else status, "offset": offset, "payload": body,
            }, len(body)

    def run(batches):
        for batch in slices(batches, 1):
            yield from _in_parts(rows(batch.column("content")[0].as_buffer().to_pybytes()), schema)

    return _binary(spark, path).mapInArrow(run, RECORD)


def w3c_date(stamp: str) -> str:
    """A 14-digit ARC date (shorter ones are filled up) as a W3C time stamp in UTC."""
    full = (stamp + "00000101000000"[len(stamp):])[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(uri: str, page: int | None, stamp: str, digest: str) -> str:
    """The same URN for the same record in every run."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{uri} {page} {stamp} {digest}')}>"


def _sha1(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _warc_records(batches):
    """One text value per record; the writer ends each with the two line ends that WARC asks for."""
    for batch in slices(batches):
        out = []
        for r in batch.to_pylist():
            payload = r["payload"]
            digest = _sha1(payload)
            revisit = r["refers_to"] is not None
            head = _http(r["page_id"], len(payload))
            block = head if revisit else head + payload
            fields = [
                "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
                f"WARC-Record-ID: {record_id(r['uri'], r['page_id'], r['stamp'], digest)}",
                f"WARC-Date: {w3c_date(r['stamp'])}", f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}",
                f"WARC-Payload-Digest: {digest}", "Content-Type: application/http;msgtype=response",
            ]
            if revisit:
                fields += [
                    f"WARC-Profile: {PROFILE}",
                    f"WARC-Refers-To: {record_id(r['refers_uri'], r['refers_to'], r['refers_stamp'], digest)}",
                    f"WARC-Refers-To-Target-URI: {r['refers_uri']}", f"WARC-Refers-To-Date: {w3c_date(r['refers_stamp'])}",
                    f"X-Refers-To-Page-Id: {r['refers_to']}",
                ]
            fields.append(f"Content-Length: {len(block)}")
            out.append("\r\n".join(fields) + "\r\n\r\n" + block.decode("utf-8", "surrogateescape"))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def to_warc(records: DataFrame, path: str, *, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Rows of :func:`read_arc` as WARC files below ``path``; payloads must be UTF-8, as Spark's text writer is.

    Which payloads are equal is decided on digests and lengths, combined before the shuffle, so a payload that a third
    of all pages have costs no more than another one. Payloads are shuffled once at most, to their referred record.
    """
    keyed = records.withColumn("size", F.octet_length("payload")).withColumn("sha", F.sha1("payload"))
    target = F.struct("page_id", "uri", "stamp")
    groups = keyed.filter(F.col("size") >= revisit_bytes).groupBy("sha", "size").agg(
        F.count(F.lit(1)).alias("n"), F.max(target).alias("to")
    ).filter(F.col("n") > 1)
    # Written first, so that its size is known when the join is planned: payloads that occur once are not in it.
    groups = durable(groups.select("sha", "size", "to"), "repeated-payloads")
    met = keyed.join(groups, ["sha", "size"], "left")
    other = ~F.col("page_id").eqNullSafe(F.col("to.page_id")) & F.col("to").isNotNull()
    rows = met.select(
        "page_id", "uri", "ip", "stamp", "payload", F.when(other, F.col("to.page_id")).alias("refers_to"),
        F.when(other, F.col("to.uri")).alias("refers_uri"), F.when(other, F.col("to.stamp")).alias("refers_stamp"),
    )
    lines = rows.mapInArrow(_warc_records, "value string")
    lines.write.options(**GZIP).option("lineSep", "\r\n\r\n").text(path)


def warc_records(content: bytes):
    """``(header fields, block)`` of every record of a WARC file."""
    source = _Unpacked(content)
    while True:
        line = source.line()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:80]!r}")
        fields = {}
        while (line := source.line()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, source.read(int(fields["content-length"]))


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """Rows of WARC files: page, type, address, date, payload (null for revisits), its full length and digest in hex,
    and what a revisit refers to. A payload that does not have the digest of its record stops the job."""
    names = [
        ("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()),
        ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ("refers_to_id", pa.string()), *([("payload", pa.binary())] if with_payload else []),
    ]
    schema = pa.schema(names)

    def rows(content):
        for fields, block in warc_records(content):
            kind = fields["warc-type"]
            http, _, body = _split_http(block)
            digest = fields["warc-payload-digest"]
            if kind == "response" and _sha1(body) != digest:
                raise ValueError(f"{fields['warc-record-id']}: the payload does not have the digest {digest}")
            page, refers = http.get("x-page-id"), fields.get("x-refers-to-page-id")
            row = {
                "page_id": int(page) if page else None, "record_id": fields["warc-record-id"], "record_type": kind,
                "uri": fields["warc-target-uri"], "date": fields["warc-date"],
                "payload_bytes": int(http["content-length"]) if kind == "revisit" else len(body),
                "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
                "refers_to": int(refers) if refers else None, "refers_to_id": fields.get("warc-refers-to"),
            }
            if with_payload:
                row["payload"] = None if kind == "revisit" else body
            yield row, len(body) if with_payload else 200

    def run(batches):
        for batch in slices(batches, 1):
            yield from _in_parts(rows(batch.column("content")[0].as_buffer().to_pybytes()), schema)

    ddl = (
        "page_id bigint, record_id string, record_type string, uri string, date string, payload_bytes bigint, "
        "payload_digest string, refers_to bigint, refers_to_id string" + (", payload binary" if with_payload else "")
    )
    return _binary(spark, path).mapInArrow(run, ddl)


def convert(pages: DataFrame, *, version: int = 1, revisit_bytes: int = REVISIT_BYTES, **columns) -> str:
    """Pages through ARC files to WARC files; the folder of the latter, in the shared folder."""
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, version=version, **columns)
    to_warc(read_arc(spark, arc), warc, revisit_bytes=revisit_bytes)
    return warc
