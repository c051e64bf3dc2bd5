"""Legacy web archives to WARC: write and parse ARC, synthesise WARC records, write and parse WARC.

An ARC file opens with a version block whose declared version says which fields a record's header line
has; each record's bytes are taken by its declared length, never by looking for the next header. For
each record the converter makes what WARC asks for and ARC lacks: an identifier (a name-based UUID of
the place the record came from, the same in every run), a timestamp in ISO form, a type, and digests of
block and payload. Of records with equal payloads one is kept as response, the others become revisits.

Archives are rows of at most ``ARCHIVE_BYTES`` (or one record), built and parsed one at a time inside
tasks, and written one per file by Spark's own writer, so any store that Spark can write will do. Each
record is a gzip member of its own. Payloads move once, when the winners are joined; a payload that a
third of all records share is dealt over ``SALTS`` parts for that.

Defined results: a null payload is an empty one, a null URL is written as ``unknown:``, blanks inside a
URL are percent-encoded. Records whose key equals the largest of their group are all responses; a
record without a key loses to any that has one. Equal rows give equal numbers of records. No rows give
archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an archive before compression.
ARCHIVE_BYTES = 8 << 20
#: Payloads of at least this many bytes are written once.
REVISIT_BYTES = 1000
SALTS = 16
_PART = 1 << 16
#: Bytes between records or members that mean nothing.
PADDING = b"\r\n\x00"
_HEAD_END = re.compile(rb"\r?\n\r?\n")
#: ARC has a capture time per record; rows without one get this.
CAPTURED = "20240101000000"

# Fixed values of the two formats.
ARC_FIELDS = {
    b"1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    b"2": [
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
    ],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY_HEADER = "X-Record-Key"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:creditloom:arc")

ARC_RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_key", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("mime", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("block", T.BinaryType()),
    ]
)
WARC_RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_key", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


# --- bytes ------------------------------------------------------------------------------------------


def members(content: bytes) -> bytes:
    """An archive's bytes, whether compressed member by member or not at all.

    Line ends and zero bytes between members and after the last are padding; anything else is an error.
    """
    magic = b"\x1f\x8b"
    if content[:2] != magic:
        return content
    out, at = [], 0
    while (at := _past(content, at, PADDING)) < len(content):
        if content[at : at + 2] != magic:
            raise ValueError(f"no compressed member at {at}: {content[at : at + 20]!r}")
        begin, unzip = at, zlib.decompressobj(wbits=31)
        while not unzip.eof and at < len(content):
            part = content[at : at + _PART]  # what is left over of a part is copied, not the rest of all
            try:
                out.append(unzip.decompress(part))
            except zlib.error as error:
                raise ValueError(f"garbled member at {begin}: {error}") from error
            at += len(part) - len(unzip.unused_data)
        if not unzip.eof:
            raise ValueError(f"the last member, at {begin}, is cut off")
    return b"".join(out)


def _past(data: bytes, at: int, padding: bytes) -> int:
    """The next place that holds no padding."""
    while at < len(data) and data[at] in padding:
        at += 1
    return at


def arc_header(version: bytes, url: str, ip: str, date: str, mime: str, length: int, **more: str) -> bytes:
    given = {
        "URL": url,
        "IP-address": ip,
        "Archive-date": date,
        "Content-type": mime,
        "Archive-length": str(length),
    } | more
    return (" ".join(given.get(f, "-") for f in ARC_FIELDS[version]) + "\n").encode()


def arc_opening(version: bytes, name: str) -> bytes:
    """The version block; its own header line has the fields of its version."""
    body = version + b" 0 creditloom\n" + " ".join(ARC_FIELDS[version]).encode() + b"\n"
    more = {"Result-code": "200", "Offset": "0", "Filename": name}
    return arc_header(version, f"filedesc://{name}", "0.0.0.0", CAPTURED, "text/plain", len(body), **more) + body + b"\n"


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record after the opening one."""
    data, at, fields = members(content), 0, None
    while (at := _past(data, at, PADDING)) < len(data):
        line_end = data.find(b"\n", at)
        if line_end < 0:
            raise ValueError(f"header line without an end at {at}")
        line = data[at:line_end].rstrip(b"\r")
        names = fields or ARC_FIELDS[b"1"]
        values = line.rsplit(b" ", len(names) - 1)  # from the right: old writers left blanks in URLs
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not a header line at {at}: {line[:80]!r}")
        length, begin = int(values[-1]), line_end + 1
        if begin + length > len(data):
            raise ValueError(f"record at {at} declares {length} bytes, {len(data) - begin} are left")
        block = data[begin : begin + length]
        if fields is None:
            version = block.split(None, 1)[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown version {version!r}")
            fields = ARC_FIELDS[version]
        else:
            yield at, {n: v.decode("utf-8", "replace") for n, v in zip(names, values)}, block
        at = begin + length


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each record; what is neither a record nor padding is an error."""
    data, at = members(content), 0
    while (at := _past(data, at, PADDING)) < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}: {data[at : at + 20]!r}")
        end = _HEAD_END.search(data, at)
        if not end:
            raise ValueError(f"record at {at} has a header without an end")
        header = _fields(data[at : end.start()])
        length = header.get("content-length", "")
        if not length.isdigit():
            raise ValueError(f"record at {at} declares no length")
        begin, length = end.end(), int(length)
        if begin + length > len(data):
            raise ValueError(f"record at {at} declares {length} bytes, {len(data) - begin} are left")
        yield header, data[begin : begin + length]
        at = begin + length


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a head, without its first line; names in lower case."""
    lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]
    return {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines)}


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, head with its blank line, and payload; a block without a head is all payload.

    Lines end with CRLF or, as in many old archives, with LF alone. A head without a blank line has no payload.
    """
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    end = _HEAD_END.search(block)
    if not end:
        return _fields(block), block, b""
    return _fields(block[: end.start()]), block[: end.end()], block[end.end() :]


def iso_date(date: str) -> str:
    """14 digits (or the first of them) as WARC writes times."""
    d = date + CAPTURED[len(date) :] if date.isdigit() and len(date) < 14 else date
    if not re.fullmatch(r"\d{14}", d):
        d = CAPTURED
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def warc_record(header: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{n}: {v}" for n, v in header.items() if v is not None]
    lines.append(f"WARC-Block-Digest: {base32(hashlib.sha1(block).hexdigest())}")
    lines.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "unknown:"


# --- archives as files ------------------------------------------------------------------------------


def _write(rows: DataFrame, records, opening, path: str, archive_bytes: int) -> None:
    """One file per archive: ``records`` turns a row into bytes, ``opening`` makes an archive's start."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], type=pa.binary())], ["archive"])

        for batch in batches:
            for row in batch.to_pylist():
                if not parts:
                    number += 1
                    version, first = opening(part, number)
                    parts, size = [gzip.compress(first, 1, mtime=0)], 0
                record = records(version, row)
                parts.append(gzip.compress(record, 1, mtime=0))
                size += len(record)
                if size >= archive_bytes:
                    yield archive()
                    parts = []
        if parts:
            yield archive()

    # a binary column passes through the text writer as it is; its line end follows the last member
    archives = rows.mapInArrow(build, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("maxRecordsPerFile", 1).text(path)


def _read(spark: SparkSession, path: str, parse, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse(content.as_py()))
                arrow = arrow or _arrow(schema)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    # an archive per batch: what a worker holds does not depend on how many Spark would send together
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema])


def write_arc(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Rows with ``record_key``, ``url`` and ``payload`` (binary) as ARC files of both versions."""

    def opening(part: int, number: int) -> tuple[bytes, bytes]:
        version = b"12"[(part + number) % 2 : (part + number) % 2 + 1]
        return version, arc_opening(version, f"{part}-{number}.arc.gz")

    def record(version: bytes, row: dict) -> bytes:
        payload = row["payload"] or b""
        key = "" if row["record_key"] is None else f"{KEY_HEADER}: {row['record_key']}\r\n"
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{key}Content-Length: {len(payload)}\r\n\r\n"
        block = head.encode() + payload
        more = {"Result-code": "200", "Checksum": hashlib.md5(block).hexdigest()}
        return arc_header(version, _url(row["url"]), "0.0.0.0", CAPTURED, "text/html", len(block), **more) + block + b"\n"

    _write(rows.select("record_key", "url", "payload"), record, opening, path, archive_bytes)


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """A row per record, with what WARC needs besides.

    ``block`` is compressed (zlib), so that it is when it is shuffled; null without ``blocks``.
    """

    def parse(content: bytes) -> Iterator[dict]:
        place = hashlib.sha1(content).hexdigest()
        for offset, header, block in arc_records(content):
            fields, _, payload = http_parts(block)
            key = fields.get(KEY_HEADER.lower(), "")
            yield {
                "record_id": str(uuid.uuid5(NAMESPACE, f"{place}/{offset}")),
                "record_key": int(key) if re.fullmatch(r"-?\d+", key) else None,
                "url": header["URL"],
                "ip": header["IP-address"],
                "warc_date": iso_date(header["Archive-date"]),
                "mime": header["Content-type"],
                "payload_bytes": len(payload),
                "payload_digest": hashlib.sha1(payload).hexdigest(),
                "block": zlib.compress(block, 1) if blocks else None,
            }

    return _read(spark, path, parse, ARC_RECORD)


def convert(spark: SparkSession, arc_path: str, warc_path: str, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """ARC files to WARC files. Of equal payloads the record with the largest key is the response."""
    same = ["payload_digest", "payload_bytes"]
    kept = (
        read_arc(spark, arc_path, blocks=False)
        .where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy(*same)
        .agg(F.max(F.struct("record_key", "record_id")).alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .select(*same, "kept", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salt = F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")
    records = read_arc(spark, arc_path).withColumn("salt", salt)
    # true also where the record has no key but the kept one has
    loses = F.col("kept.record_key").isNotNull() & ~F.col("record_key").eqNullSafe(F.col("kept.record_key"))
    rows = records.join(kept, [*same, "salt"], "left").select(
        *[c for c in records.columns if c != "salt"],
        F.when(loses, F.col("kept.record_id")).alias("refers_to_id"),
        F.when(loses, F.col("kept.record_key")).alias("refers_to"),
    )

    def opening(part: int, number: int) -> tuple[bytes, bytes]:
        name = f"{part}-{number}.warc.gz"
        body = b"software: creditloom\r\nformat: WARC File Format 1.1\r\n"
        header = {
            "WARC-Type": "warcinfo",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>",
            "WARC-Date": iso_date(CAPTURED),
            "WARC-Filename": name,
            "Content-Type": "application/warc-fields",
        }
        return b"", warc_record(header, body)

    def record(_: bytes, row: dict) -> bytes:
        block = zlib.decompress(row["block"])
        _, head, _ = http_parts(block)
        revisit = row["refers_to_id"] is not None
        header = {
            "WARC-Type": "revisit" if revisit else "response" if head else "resource",
            "WARC-Record-ID": f"<urn:uuid:{row['record_id']}>",
            "WARC-Date": row["warc_date"],
            "WARC-Target-URI": row["url"],
            "WARC-IP-Address": row["ip"],
            "Content-Type": "application/http;msgtype=response" if head else row["mime"],
            "WARC-Payload-Digest": base32(row["payload_digest"]),
            "WARC-Profile": REVISIT_PROFILE if revisit else None,
            "WARC-Refers-To": f"<urn:uuid:{row['refers_to_id']}>" if revisit else None,
            # an extension field: readers that don't know it pass over it
            "WARC-Refers-To-Key": str(row["refers_to"]) if revisit else None,
        }
        return warc_record(header, head if revisit else block)

    _write(rows, record, opening, warc_path, archive_bytes)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per response, resource or revisit. A revisit's size and digest are those it declares."""

    def bare(urn: str | None) -> str | None:
        return urn.strip("<>").removeprefix("urn:uuid:") if urn else None

    def parse(content: bytes) -> Iterator[dict]:
        for header, block in warc_records(content):
            kind = header["warc-type"]
            if kind == "warcinfo":
                continue
            fields, _, payload = http_parts(block)
            key = fields.get(KEY_HEADER.lower(), "")
            refers = header.get("warc-refers-to-key", "")
            if kind == "revisit":
                size = int(fields.get("content-length", "0"))
                digest = base64.b32decode(header["warc-payload-digest"].removeprefix("sha1:")).hex()
            else:
                size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            yield {
                "record_id": bare(header["warc-record-id"]),
                "record_key": int(key) if re.fullmatch(r"-?\d+", key) else None,
                "record_type": kind,
                "url": header.get("warc-target-uri"),
                "warc_date": header["warc-date"],
                "payload_bytes": size,
                "payload_digest": digest,
                "refers_to": int(refers) if re.fullmatch(r"-?\d+", refers) else None,
                "refers_to_id": bare(header.get("warc-refers-to")),
                "payload": payload if payloads and kind != "revisit" else None,
            }

    return _read(spark, path, parse, WARC_RECORD)


def page_rows(pages: DataFrame, key: Column, url: Column, html: Column) -> DataFrame:
    """Rows for ``write_arc``: the payload is the text in UTF-8, a null one is empty."""
    return pages.select(
        key.cast("long").alias("record_key"),
        url.alias("url"),
        F.coalesce(html, F.lit("")).cast("binary").alias("payload"),
    )
