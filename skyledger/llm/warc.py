"""Dictionary-compressed WARC archives (operator 3).

Archives are ordinary files written and read by Spark itself, so they can lie in any store Spark
reaches and a lost task is written anew by another. One archive is

    a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary,
    one Zstandard frame per WARC record, compressed with that dictionary,
    an empty skippable frame (what Spark's writer puts after a row).

The dictionary is built from the archive's own records: evenly spaced ones, SAMPLE_BYTES in all at
most. An archive takes records up to ARCHIVE_BYTES (a larger record has one alone), so memory is
bounded. Records of equal payloads of at least `min_bytes` bytes: the one with the smallest page_id
is a response, the others are revisits that refer to it; a revisit keeps the HTTP head and leaves the
payload out.

Defined results: a null html is an empty payload; a null url or page_id gives no such header; rows
that share the smallest page_id of a payload are all responses; a null page_id is a response unless
its payload also occurs with a page_id; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import register, table
from skyledger.session import scratch_dir

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 48 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
MIN_BYTES = 0

# Fixed values of the Zstandard and WARC formats.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"          # 0x184D2A50 and size 0, little-endian; all ASCII
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")       # RFC 4122's for URLs
_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def _one_line(text: str) -> str:
    """A header value: control characters would end it."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. `refers_to`: the page whose record has the payload, for a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", _record_id(page_id)),
              ("WARC-Date", _DATE),
              ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
              ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def read_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload as far as it is in the record), by lower-case name."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])}


def dictionary_of(records: list[bytes]) -> bytes:
    """A trained dictionary, or the records' own bytes where they are too few to train on."""
    import zstandard
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[:DICTIONARY_BYTES] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archive(records: list[bytes]) -> bytes:
    import zstandard
    raw = dictionary_of(records)
    dictionary = zstandard.ZstdCompressionDict(raw)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw, *map(compressor.compress, records)])


def read_archive(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard
    view, at, reader = memoryview(content), 0, None
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at) if at + 8 <= len(view) else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size])))
            at += 8 + size
        elif magic == FRAME_MAGIC and reader is not None:
            frame = reader.decompressobj()
            yield frame.decompress(view[at:])
            at = len(view) - len(frame.unused_data)
        else:
            raise ValueError(f"no frame at byte {at} of the archive")


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, payload_sha1, refers_to) of the rows that revisit an equal payload."""
    keyed = pages.select("page_id", _payload().alias("payload")).filter(F.octet_length("payload") >= min_bytes).select(
        "page_id", F.sha1("payload").alias("payload_sha1"))
    first = keyed.groupBy("payload_sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keyed.join(first, "payload_sha1").filter("refers_to IS NOT NULL AND NOT page_id <=> refers_to").select(
        "page_id", "payload_sha1", "refers_to").distinct()


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """A record per row of `pages` (page_id, url, html), in archives under `path`."""
    known = revisits(pages, min_bytes)
    found = known.select(F.col("page_id").alias("__id"), F.col("payload_sha1").alias("__sha1"), "refers_to")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), _payload().alias("payload"))
    rows = rows.join(found, rows["page_id"].eqNullSafe(found["__id"]) & (F.sha1(rows["payload"]) == found["__sha1"]), "left").select(
        "page_id", "url", "payload", "refers_to")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = write_record(*values)
                if records and size + len(record) > ARCHIVE_BYTES:
                    yield _row(write_archive(records))
                    records, size = [], 0
                records.append(record)
                size += len(record)
        if records:
            yield _row(write_archive(records))

    def _row(archive: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])

    archives = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark, path: str, id_type: str = "long") -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for a revisit)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for rows in _in_parts(map(_parsed, read_archive(content.as_buffer()))):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    got = spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        run, "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
    return got.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]


def _parsed(record: bytes) -> tuple:
    fields, http, payload = read_record(record)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    if response and (payload_digest(payload) != digest or len(payload) != int(http["content-length"])):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return (fields.get("x-page-id"), fields.get("warc-target-uri"), fields["warc-type"], fields.get("x-refers-to-page-id"),
            int(http["content-length"]), digest, payload if response else None)


def _in_parts(rows: Iterable[tuple], most: int = 256) -> Iterator[list[tuple]]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == most:
            yield part
            part = []
    if part:
        yield part


@register("op3_warc_dictionary_archives")
def op3_warc_dictionary_archives(spark, sf_dir):
    path = scratch_dir(spark, "archives")
    pages = table(spark, sf_dir, "pages")
    write_archives(pages, path)
    return read_archives(spark, path, pages.schema["page_id"].dataType.simpleString()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
