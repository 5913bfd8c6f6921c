"""Legacy web archives (ARC, versions 1 and 2) converted to WARC, and both read in Spark.

An ARC file opens with a version block that names the fields of its header lines; each
record is one such line and as many bytes as the line declares. The converter keeps the
bytes, and makes what a WARC record has besides: an identifier from the record's place in
its archive (the same in every run), an ISO time, digests, and a type. Of the records whose
payloads are equal, the one with the largest page id is the ``response``; the others become
``revisit`` records that refer to it and hold the HTTP head alone.

Equality is decided on SHA-256 of the payload. The choice is an aggregate with map-side
combining, joined back to the records by digest; each digest is once in it, so Spark can
split a payload that many records share. Archives are read as whole files, one record at a
time, and written by Spark's own writer into shared storage, gzip-compressed as a whole.

Defined results: a NULL payload is empty; a NULL url is written as ``-`` and read as NULL;
white space and control characters in urls are percent-encoded; a NULL page id is left out
of the record, read as NULL, and smaller than every id. Of records with one page id and
one payload, the last in archive order is the response. Empty tables give archives without
records. Further columns of the input are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Header-line fields by version, fixed values of the format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
RECORDS_PER_FILE = 1000
_NO_IP = "0.0.0.0"
#: Hadoop's name for the level: most of a conversion's time is spent on compressing.
_GZIP_LEVEL = {"zlib.compress.level": "BEST_SPEED"}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ARC


def arc_version_block(name: str, date: str, version: int) -> bytes:
    body = f"{version} 0 curbline\n{ARC_FIELDS[version]}\n".encode()
    fields = {"URL": f"filedesc://{name}", "IP-address": _NO_IP, "Archive-date": date, "Content-type": "text/plain"}
    return _arc_line(fields, body, version) + body


def _arc_line(fields: dict[str, str], body: bytes, version: int) -> bytes:
    known = fields | {"Archive-length": str(len(body))}
    return (" ".join(known.get(f, "-") for f in ARC_FIELDS[version].split()) + "\n").encode()


def _clean_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


def write_arc(
    pages: DataFrame,
    path: str,
    version: int,
    date: str = "20240101000000",
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Archives of (page_id, url, html) rows."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            out = []
            for page, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                # The writer starts a file every so many rows; each opens with a version block.
                if written % (records_per_file + 1) == 0:
                    out.append(arc_version_block("pages.arc", date, version))
                    written += 1
                payload = (html or "").encode("utf-8", "surrogatepass")
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
                head += f"Content-Length: {len(payload)}\r\n"
                head += f"{PAGE_HEADER}: {page}\r\n\r\n" if page is not None else "\r\n"
                block = head.encode() + payload
                fields = {"URL": _clean_url(url), "IP-address": _NO_IP, "Archive-date": date}
                fields |= {"Content-type": "text/html", "Result-code": "200", "Checksum": sha1_base32(block)}
                out.append(_arc_line(fields, block, version) + block)
                written += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(lines, "value binary")
    # A record ends with a line feed: the writer's own.
    _write_records(rows, path, records_per_file + 1)


def _write_records(rows: DataFrame, path: str, per_file: int) -> None:
    (
        rows.select(F.col("value").cast("string"))
        .write.options(lineSep="\n", compression="gzip", maxRecordsPerFile=per_file, **_GZIP_LEVEL)
        .text(path)
    )


class ArcRecord(NamedTuple):
    fields: dict[str, str]
    offset: int
    block: bytes


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """The records of one archive, by its version block and the declared lengths."""
    names, offset = ARC_FIELDS[1].split(), 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        parts = line.decode("utf-8", "surrogateescape").split()
        size = int(parts[-1])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record at {start} declares {size} bytes, {len(block)} are left")
        offset += size
        if parts[0].startswith("filedesc://"):
            version, *_ = block.split(b"\n", 1)[0].split()
            names = ARC_FIELDS[int(version)].split()
            continue
        # A content type may hold blanks: what is too many belongs to it.
        spare, at = len(parts) - len(names), names.index("Content-type")
        if spare < 0:
            raise ValueError(f"header line at {start} has {len(parts)} of {len(names)} fields")
        parts[at : at + spare + 1] = [" ".join(parts[at : at + spare + 1])]
        yield ArcRecord(dict(zip(names, parts, strict=True)), start, block)


def _opened(content: bytes) -> BinaryIO:
    return gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return b"", block
    return block[: end + 4], block[end + 4 :]


def _header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def iso_date(digits: str) -> str:
    """ISO time of an archive date, which early files shorten to a day or a minute."""
    d = digits + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_PARSED = (
    "record_id string, uri string, ip string, date string, page_id long, sha256 binary,"
    " digest string, head binary, payload binary"
)


def parse_arcs(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """The records of all archives under ``path``, with what WARC needs.

    Without ``bodies``, ``digest``, ``head`` and ``payload`` are NULL.
    """
    names = [c.split()[0] for c in _PARSED.split(", ")]
    schema = pa.schema(
        [pa.field(n, {"long": pa.int64(), "string": pa.string()}.get(k, pa.binary())) for n, k in (c.split() for c in _PARSED.split(", "))]
    )

    def rows(name: str, content: bytes) -> Iterator[tuple]:
        for record in read_arc(_opened(content)):
            head, payload = split_http(record.block)
            page = _header(head, PAGE_HEADER)
            uri, ip = record.fields["URL"], record.fields["IP-address"]
            yield (
                f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{record.offset}')}",
                None if uri == "-" else uri,
                None if ip == _NO_IP else ip,
                iso_date(record.fields["Archive-date"]),
                int(page) if page else None,
                hashlib.sha256(payload).digest(),
                sha1_base32(payload) if bodies else None,
                head if bodies else None,
                payload if bodies else None,
            )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                # Only the archive's own name: identifiers don't depend on the folder.
                for row in rows(name.as_py().rsplit("/", 1)[-1], content.as_py()):
                    out.append(row)
                    size += len(row[-1] or b"") + 256
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)
                        out, size = [], 0
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(parse, _PARSED)


# ---------------------------------------------------------------- WARC


def decide_types(parsed: DataFrame, light: DataFrame) -> DataFrame:
    """``parsed`` with ``first``: the response of its payload, or NULL for that one itself.

    ``light`` are the same records without bodies.
    """
    light = light.select("sha256", "page_id", "record_id", "uri", "date")
    best = F.max(F.struct("page_id", "record_id", "uri", "date")).alias("first")
    chosen = light.groupBy("sha256").agg(best)
    own = F.col("first.record_id") == F.col("record_id")
    return parsed.join(chosen, "sha256").withColumn("first", F.when(~own, F.col("first")))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """``Name: value`` lines; one whose value is NULL is left out."""
    return F.concat(
        *[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in pairs]
    )


def write_warc(decided: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """WARC 1.1 archives of ``decide_types``'s rows."""
    first, revisit = F.col("first"), F.col("first").isNotNull()
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    has_head = F.length("head") > 0
    named = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    head = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", named(F.col("record_id"))),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-IP-Address", F.col("ip")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        # A revisit has no payload that could be measured.
        (LENGTH_FIELD, F.when(revisit, F.length("payload").cast("string"))),
        ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        ("WARC-Refers-To", named(first["record_id"])),
        ("WARC-Refers-To-Target-URI", first["uri"]),
        ("WARC-Refers-To-Date", first["date"]),
        ("Content-Type", F.when(has_head, "application/http; msgtype=response").otherwise("application/octet-stream")),
        ("Content-Length", F.length(block).cast("string")),
    )
    # Two line ends close a record; the writer adds the last line feed.
    text = F.concat(F.lit(b"WARC/1.1\r\n"), head.cast("binary"), F.lit(b"\r\n"), block, F.lit(b"\r\n\r"))
    _write_records(decided.select(text.alias("value")), path, records_per_file)


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names lower-cased) and block of every record of one archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{fields.get('warc-record-id')} declares {size} bytes, {len(block)} are left")
        yield fields, block


#: Of a revisit: how many bytes the payload has that it refers to.
LENGTH_FIELD = "WARC-Payload-Length"

_RECORDS = (
    "record_id string, record_type string, uri string, date string, page_id long, payload_bytes long,"
    " payload_digest string, refers_to_id string, intact boolean"
)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """One row per record under ``path``; ``intact``: the block has the digest it declares.

    ``payload_bytes`` of a revisit is what its record says, or its HTTP header; NULL where neither does.
    """
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([pa.field(n, kinds[k]) for n, k in (c.split() for c in _RECORDS.split(", "))])

    def row(fields: dict[str, str], block: bytes) -> dict:
        head, payload = split_http(block)
        page, digest = _header(head, PAGE_HEADER), fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        told = [fields.get(LENGTH_FIELD.lower()), _header(head, "Content-Length")]
        known = next((int(n) for n in told if n is not None and n.isdecimal()), None)
        size = known if revisit else len(payload)
        values = (
            fields["warc-record-id"].strip("<>"),
            fields["warc-type"],
            fields.get("warc-target-uri"),
            fields["warc-date"],
            int(page) if page else None,
            size,
            digest,
            fields["warc-refers-to"].strip("<>") if revisit else None,
            revisit or sha1_base32(payload) == digest,
        )
        return dict(zip(names, values, strict=True))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [row(*record) for record in read_warc(_opened(content.as_py()))]
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, _RECORDS)


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """All ARC archives under ``arc_path`` as WARC archives under ``warc_path``."""
    decided = decide_types(parse_arcs(spark, arc_path), parse_arcs(spark, arc_path, bodies=False))
    write_warc(decided, warc_path)


def with_referred_page(records: DataFrame) -> DataFrame:
    """``read_warcs``'s rows with ``refers_to``, the page id of the record referred to."""
    targets = records.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(targets, "refers_to_id", "left")
