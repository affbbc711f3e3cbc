"""Legacy archive converter: ARC files to WARC files and back to rows.

An ARC file starts with a version block (``filedesc://...``) that declares the
version and the names of the header fields; every record is one header line with
those fields, the last of them the length of the block that follows.  Version 1
has five fields, version 2 ten.  :func:`read_arc` parses header lines and declared
lengths from the byte stream of each file, :func:`convert` gives every record its
WARC identifier, timestamp, type and digests and turns repeated payloads into
revisits, :func:`write_warc` and :func:`read_warc` store and read the result, and
:func:`resolve` answers revisits from the records that they refer to.

Files are written and read by Spark's text source, so that any store that Spark
reaches will do: a record's closing line break(s) are the line separator, pieces
between separators are joined again by the parser, which relies on nothing but
declared lengths.  Files are compressed as a whole, so each is read in order by
one task; a file holds one partition of the writer.  Payloads are parsed twice
(first for their digests alone), so that no payload is shuffled while the table
of repeated payloads passes the size check of a broadcast.

Defined results: NULL html is an empty payload; a NULL or empty url is ``-`` in
ARC and an ``urn:arc:`` name in WARC; white space and control characters in a url
are percent-encoded; of equal payloads the record with the smallest key is the
response (NULL keys last, then archive position, so that repeated rows give
one response and revisits); payloads shorter than ``min_bytes`` are all responses;
a header line that doesn't parse is skipped up to the next one that does; a record
cut off by the end of its file keeps the bytes that are there and is marked
``WARC-Truncated``; an empty table gives archives without pages.  Only the named
columns are read, so other columns of the table cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote_from_bytes, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize, sized_broadcast, table

# The header fields that the two versions of the format declare.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_HEADER = "X-Archive-Key"
ARC_END, WARC_END = "\n", "\r\n\r\n"
MIN_BYTES = 0
OUT_BYTES = 4 << 20
FIRST_CAPTURE, CAPTURE_SPAN = 852_076_800, 315_360_000  # 1997, ten years


# ---- byte streams --------------------------------------------------------------

class Pieces:
    """The bytes of one file from its pieces, each followed by a separator."""

    def __init__(self, pieces: Iterator[bytes], separator: bytes):
        self.pieces, self.separator, self.buffer, self.offset = pieces, separator, bytearray(), 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.buffer += piece
        self.buffer += self.separator
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is consumed; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        return self.take(at + len(mark))[:at]

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes; fewer at the end of the file, and then without the
        separator that may not be there."""
        while len(self.buffer) < n:
            if not self._more():
                n = max(0, len(self.buffer) - len(self.separator))
                break
        out = bytes(memoryview(self.buffer)[:n])
        del self.buffer[:n]
        self.offset += len(out)
        return out


def _files(batches: Iterator[pa.RecordBatch], separator: str) -> Iterator[Pieces]:
    """One stream per file of a task."""
    rows = (row for batch in batches for row in zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist()))
    for _, own in groupby(rows, key=lambda row: row[0]):
        yield Pieces((piece or b"" for _, piece in own), separator.encode())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``OUT_BYTES`` (of the byte columns at ``sizes``)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + sum(len(row[i] or b"") for i in sizes)
        if size > OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC -----------------------------------------------------------------------

def arc_url(url: str | None) -> str:
    """A url without the white space that would split a header line."""
    raw = (url or "").encode()
    return quote_from_bytes(raw, safe=bytes(range(0x21, 0x7F))) if raw.strip() else "-"


def http_block(html: bytes, key: str | None) -> bytes:
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(html)]
    if key is not None:
        head.append(f"{KEY_HEADER}: ".encode() + quote_from_bytes(key.encode()).encode())
    return b"\r\n".join([*head, b"", html])


def _arc_records(batches: Iterator[pa.RecordBatch], part: int, version: int) -> Iterator[tuple]:
    """The records of one ARC file, its version block first."""
    name, offset = f"part-{part:06d}.arc", 0
    fields = FIELDS[version]

    def line(url: str, date: str, kind: str, code: str, length: int) -> bytes:
        more = f"{code} - - {offset} {name} " if version == 2 else ""
        return f"{url} 0.0.0.0 {date} {kind} {more}{length}\n".encode()

    about = f"{version} 0 foldwise\n{fields}\n".encode()
    record = line(f"filedesc://{name}", "19970101000000", "text/plain", "200", len(about)) + about
    yield (record,)
    offset += len(record) + len(ARC_END)
    for batch in batches:
        for key, url, html, date in zip(*[batch.column(c).to_pylist() for c in ("key", "url", "html", "date")]):
            block = http_block(html or b"", key)
            record = line(arc_url(url), date, "text/html", "200", len(block)) + block
            yield (record,)
            offset += len(record) + len(ARC_END)


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
              captured: Column | None = None, versions: tuple = (1, 2)) -> None:
    """Store ``pages`` as ARC files, one per partition, of the given versions in
    turn.  ``captured`` is the capture time of a row, by default one drawn from a
    hash of its key and url."""
    when = captured if captured is not None else F.timestamp_seconds(
        F.lit(FIRST_CAPTURE) + F.pmod(F.xxhash64(F.col(key), F.col(url)), F.lit(CAPTURE_SPAN)))
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(url).cast("string").alias("url"),
                        F.encode(F.col(html), "UTF-8").alias("html"), F.date_format(when, "yyyyMMddHHmmss").alias("date"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _in_batches(_arc_records(batches, part, versions[part % len(versions)]), pa.schema([("record", pa.binary())]), [0])

    _write(rows.mapInArrow(run, "record binary"), path, ARC_END)


def _write(records: DataFrame, path: str, separator: str) -> None:
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", separator)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def header_fields(line: bytes, names: list[str]) -> dict[str, str] | None:
    """The fields of a header line, None if it isn't one.  Fields are counted from
    the right: old crawlers left spaces in urls."""
    cut = line.rstrip(b"\r").rsplit(b" ", len(names) - 1)
    if len(cut) != len(names) or not cut[0].strip() or not cut[-1].isdigit() or not re.fullmatch(rb"\d{4,17}", cut[names.index("Archive-date")]):
        return None
    return dict(zip(names, (c.decode("utf-8", "replace") for c in cut)))


def iso_date(digits: str | None, other: str = "1970-01-01T00:00:00Z") -> str:
    """``yyyyMMddHHmmss``, or its first 4 to 12 digits, as WARC-Date."""
    if not digits or not digits.isdigit() or len(digits) < 4:
        return other
    d = digits[:14] + "00000101000000"[len(digits[:14]):] if len(digits) % 2 == 0 else ""
    month, day, hour, minute, second = (int(d[i:i + 2]) for i in range(4, 14, 2)) if d else (0,) * 5
    ok = 1 <= month <= 12 and 1 <= day <= 31 and hour < 24 and minute < 60 and second < 61
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z" if ok else other


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with its empty line) and payload of an HTTP block."""
    if not block.startswith(b"HTTP/"):
        return None
    ends = [(at + len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := block.find(mark)) >= 0]
    return (block[:min(ends)], block[min(ends):]) if ends else (block, b"")


def head_value(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace").strip() if m else None


def _arc_rows(stream: Pieces, bodies: bool) -> Iterator[tuple]:
    """(arc, offset, version, record_id, type, date, uri, ip, content_type, key,
    head_bytes, size, block_digest, head_digest, payload_digest, identity, truncated, block)."""
    arc, version, names, other, info = "", 1, FIELDS[1].split(), "1970-01-01T00:00:00Z", None
    while True:
        offset = stream.offset
        line = stream.until(b"\n")
        if line is None:
            return
        fields = header_fields(line, names)
        if offset == 0 and line.startswith(b"filedesc://"):  # in the form of its own version: the length is last in both
            first = line.split()
            if len(first) < 5 or not first[-1].isdigit():
                continue
            block = stream.take(int(first[-1]))
            about = block.decode("utf-8", "replace").split("\n")
            version = int(about[0].split()[0]) if about[0][:1].isdigit() else 1
            if len(about) > 1 and "Archive-length" in about[1]:
                names = about[1].split()
            else:
                names = FIELDS.get(version, FIELDS[1]).split()
            arc, other = first[0].decode("utf-8", "replace")[len("filedesc://"):], iso_date(first[2].decode("ascii", "replace"))
            info = _urn(arc, offset, block)
            digest = base32_sha1(block)
            body = f"software: foldwise\r\nformat: WARC File Format 1.0\r\nconformsTo: arc/{version}\r\n".encode()
            yield (arc, offset, version, info, "warcinfo", other, None, None, "application/warc-fields", None, 0, len(body),
                   base32_sha1(body), digest, None, None, False, body if bodies else None)
            continue
        if fields is None:
            continue  # an empty line between records, or damage: on to the next line that parses
        length = int(fields["Archive-length"])
        block = stream.take(length)
        parts = http_parts(block)
        head, payload = parts or (b"", block)
        key = head_value(head, KEY_HEADER) if parts else None
        uri = fields["URL"] if fields["URL"] != "-" else f"urn:arc:{arc}:{offset}"
        yield (arc, offset, version, _urn(arc, offset, block), "response" if parts else "resource", iso_date(fields["Archive-date"], other),
               quote_from_bytes(uri.encode(), safe=bytes(range(0x21, 0x7F))), fields["IP-address"],
               "application/http; msgtype=response" if parts else fields["Content-type"], None if key is None else unquote(key),
               len(head), len(payload), base32_sha1(block), base32_sha1(head), base32_sha1(payload),
               hashlib.sha256(payload).digest(), len(block) < length, block if bodies else None)


def _urn(arc: str, offset: int, block: bytes) -> str:
    """An identifier that is the same whenever the archive is converted again."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{arc}#{offset}#{hashlib.sha1(block).hexdigest()}").urn


ARC_SCHEMA = ("arc string, offset long, version int, record_id string, type string, date string, uri string, ip string, "
              "content_type string, key string, head_bytes long, size long, block_digest string, head_digest string, "
              "payload_digest string, identity binary, truncated boolean, block binary")


def read_arc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """One row per record of the ARC files under ``path``; ``block`` is NULL
    without ``bodies``."""
    schema = _arrow(ARC_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _files(batches, ARC_END):
            yield from _in_batches(_arc_rows(stream, bodies), schema, [len(schema) - 1])

    return _pieces(spark, path, ARC_END).mapInArrow(run, ARC_SCHEMA)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


# ---- conversion ----------------------------------------------------------------

def convert(spark: SparkSession, arc_path: str, key_type: str = "bigint", min_bytes: int = MIN_BYTES) -> DataFrame:
    """WARC records (record binary) of the ARC files under ``arc_path``."""
    typed = F.col("key").cast(key_type)
    own = materialize(read_arc(spark, arc_path, bodies=False).where(f"type = 'response' and size >= {int(min_bytes)}").select(
        "identity", "size", F.struct(typed.isNull().alias("blank"), typed.alias("key"), "arc", "offset", "record_id", "uri", "date").alias("at")))
    # repeated payloads only; counted with a map-side combine, however often one repeats
    firsts = materialize(own.groupBy("identity", "size").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
                         .select(F.col("identity").alias("of"), F.col("size").alias("of_size"), "first"))
    records = read_arc(spark, arc_path)
    found = records.join(sized_broadcast(firsts), (F.col("type") == "response") & (F.col("identity") == F.col("of")) & (F.col("size") == F.col("of_size")), "left")
    again = F.col("first").isNotNull() & ~((F.col("arc") == F.col("first.arc")) & (F.col("offset") == F.col("first.offset")))
    return found.withColumn("again", again).select(_rendered().alias("record"))


def _rendered() -> Column:
    """The bytes of a WARC record up to, and without, its closing empty lines."""
    again = F.col("again")
    block = F.when(again, F.expr("substring(block, 1, cast(head_bytes as int))")).otherwise(F.col("block"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    lines = [
        F.lit("WARC/1.0"),
        field("WARC-Type", F.when(again, "revisit").otherwise(F.col("type"))),
        field("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        field("WARC-Date", F.col("date")),
        field("WARC-Filename", F.when(F.col("type") == "warcinfo", F.col("arc"))),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-IP-Address", F.when(F.col("ip") != "0.0.0.0", F.col("ip"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.when(F.col("type") != "warcinfo", F.col("payload_digest")))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("block_digest")))),
        field("WARC-Truncated", F.when(F.col("truncated"), "unspecified")),
        field("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To", F.when(again, F.concat(F.lit("<"), F.col("first.record_id"), F.lit(">")))),
        field("WARC-Refers-To-Target-URI", F.when(again, F.col("first.uri"))),
        field("WARC-Refers-To-Date", F.when(again, F.col("first.date"))),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n")).cast("binary"), block)


def write_warc(records: DataFrame, path: str) -> None:
    """Store WARC records as files, one per partition."""
    _write(records, path, WARC_END)


# ---- WARC ----------------------------------------------------------------------

WARC_SCHEMA = ("record_id string, type string, date string, uri string, refers_id string, key string, payload_bytes long, "
               "payload_digest string, intact boolean, payload binary")


def _warc_rows(stream: Pieces, bodies: bool) -> Iterator[tuple]:
    while True:
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        at = head.rfind(b"WARC/1.")
        length = head_value(head[at:], "Content-Length") if at >= 0 else None
        if length is None or not length.isdigit():
            continue
        named = lambda name: head_value(head[at:], name)  # noqa: E731,B023
        block = stream.take(int(length))
        stream.take(len(WARC_END))
        kind = named("WARC-Type")
        parts = http_parts(block) if (named("Content-Type") or "").startswith("application/http") else None
        http, payload = parts or (b"", block)
        key = head_value(http, KEY_HEADER) if parts else None
        declared, of_block = (named("WARC-Payload-Digest") or "").removeprefix("sha1:"), (named("WARC-Block-Digest") or "").removeprefix("sha1:")
        intact = len(block) == int(length) and (not of_block or of_block == base32_sha1(block))
        if kind == "revisit":  # the payload is elsewhere
            size, digest, payload = None, declared, None
        else:
            size, digest = len(payload), base32_sha1(payload)
            intact = intact and (not declared or declared == digest)
        yield ((named("WARC-Record-ID") or "").strip("<>"), kind, named("WARC-Date"), named("WARC-Target-URI"),
               (named("WARC-Refers-To") or "").strip("<>") or None, None if key is None else unquote(key), size, digest, intact,
               payload if bodies else None)


def read_warc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """One row per record of the WARC files under ``path``; ``intact`` says that
    lengths and digests are as declared.  Revisits have no payload of their own."""
    schema = _arrow(WARC_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _files(batches, WARC_END):
            yield from _in_batches(_warc_rows(stream, bodies), schema, [len(schema) - 1])

    return _pieces(spark, path, WARC_END).mapInArrow(run, WARC_SCHEMA)


def resolve(records: DataFrame) -> DataFrame:
    """Captures (responses and revisits) of ``read_warc``: key, payload_bytes,
    payload_digest, record_type, refers_to (the key of the response that a revisit
    refers to), intact.  A revisit whose response is missing is not intact."""
    own = materialize(records.where("type in ('response', 'revisit')").drop("payload"))
    asked = own.where("refers_id is not null").select(F.col("refers_id").alias("wanted")).distinct()
    there = own.where("type = 'response'").join(asked, F.col("record_id") == F.col("wanted")).select(
        "wanted", F.col("key").alias("refers_to"), F.col("payload_bytes").alias("there_bytes"), F.col("payload_digest").alias("there_digest"))
    found = own.join(sized_broadcast(materialize(there)), F.col("refers_id") == F.col("wanted"), "left")
    same = F.col("refers_id").isNull() | F.coalesce(F.col("there_digest") == F.col("payload_digest"), F.lit(False))
    return found.select("key", F.coalesce("payload_bytes", "there_bytes").alias("payload_bytes"), "payload_digest",
                        F.col("type").alias("record_type"), "refers_to", (F.col("intact") & same).alias("intact"))


def round_trip(pages: DataFrame, key: str = "page_id", min_bytes: int = MIN_BYTES, **columns) -> DataFrame:
    """``pages`` to ARC, converted to WARC, read back: the result of
    :func:`resolve` with the key in its own type."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    kind = pages.schema[key].dataType.simpleString()
    write_arc(pages, arc, key=key, **columns)
    write_warc(convert(spark, arc, kind, min_bytes), warc)
    back = resolve(read_warc(spark, warc, bodies=False))
    return back.withColumns({"key": F.col("key").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def query(spark, sf_dir):
    back = round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


ORACLE = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex, coalesce(html, '') AS payload FROM pages),
spelled AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload,
    list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform(range(4), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) >> (15 - 5 * j)) & 31) + 1, 1)),
      'string_agg', '')), 'string_agg', '') AS payload_digest FROM hashed),
firsts AS (SELECT payload, min(page_id) AS first_id FROM spelled GROUP BY payload)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
  CASE WHEN s.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN s.page_id = f.first_id THEN NULL ELSE f.first_id END AS refers_to, true AS intact
FROM spelled s JOIN firsts f ON s.payload = f.payload
"""
