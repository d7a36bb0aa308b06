"""Operator 3: an exact round trip, and the formats byte by byte."""

import base64
import glob
import hashlib
import random
import struct
import tempfile

import pytest
import zstandard
from pyspark.sql import functions as F

from skyledger.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages():
    rng = random.Random(3)
    body = lambda: "<html>" + " ".join(rng.choice(["<p>é</p>", "word", "\r\n", "&amp;"]) for _ in range(rng.randint(0, 300)))
    rows = [(i, f"http://h{i % 5}.example/{i}", body()) for i in range(120)]
    rows += [(200 + i, None, rows[7][2]) for i in range(30)]
    rows += [(-5, "http://x/\r\nWARC-Type: fake", rows[9][2]), (300, "u", None), (301, "u", ""), (302, None, None), (303, "u", "\r\n\r\n"),
             (None, "u", rows[11][2]), (None, "u", "alone"), (5, "again", rows[5][2]), (304, "u", "x" * 200_000)]
    rng.shuffle(rows)
    return rows


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = len(payload) >= min_bytes and first.get(html or "") is not None and first[html or ""] != i
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, df, **options):
    path = f"{tempfile.mkdtemp(prefix='warc-')}/archives"
    warc.write_archives(df, path, **options)
    return path, warc.read_archives(spark, path)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 20_000])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    rows = pages()
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA + ", payload int, refers_to string").repartition(3)
    path, back = round_trip(spark, df)
    assert found(back) == expected(rows)
    # payloads and addresses come back unchanged (a line end in an address is written as %0D%0A)
    got = sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in back.filter("record_type = 'response'").collect()), key=str)
    responses = {(e[0], e[2]) for e in expected(rows) if e[3] == "response"}
    want = [(i, u if u is None else u.replace("\r\n", "%0D%0A"), h or "") for i, u, h in rows
            if (i, base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) in responses]
    assert got == sorted(want, key=str)
    assert len(glob.glob(f"{path}/part-*")) >= (3 if archive_bytes > 1e6 else 10)


def test_small_payloads_stay_responses(spark):
    rows = pages()
    _, back = round_trip(spark, spark.createDataFrame(rows, SCHEMA), min_bytes=50)
    assert found(back) == expected(rows, 50)


def test_an_archive_is_a_dictionary_frame_and_one_frame_a_record(spark):
    rows = pages()
    path, _ = round_trip(spark, spark.createDataFrame(rows, SCHEMA).repartition(2))
    records = 0
    for name in glob.glob(f"{path}/part-*"):
        content = open(name, "rb").read()
        magic, size = struct.unpack_from("<II", content)
        assert magic == 0x184D2A5D and 0 < size <= warc.DICTIONARY_BYTES
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8:8 + size]))
        rest = content[8 + size:]
        while rest[:4] == b"\x28\xb5\x2f\xfd":
            frame = reader.decompressobj()
            record = frame.decompress(rest)
            rest = frame.unused_data
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert record.count(b"WARC-Record-ID: <urn:uuid:") == 1
            records += 1
        assert rest == warc.EMPTY_FRAME.encode("latin-1")          # a skippable frame of no bytes
    assert records == len(rows)


def test_revisits_leave_the_payload_out():
    full = warc.write_record(3, "http://a", b"payload " * 50, None)
    again = warc.write_record(4, "http://a", b"payload " * 50, 3)
    assert b"payload payload" in full and b"payload payload" not in again
    fields, http, payload = warc.read_record(again)
    assert (fields["warc-type"], http["content-length"], payload) == ("revisit", "400", b"")
    assert fields["warc-refers-to"] == warc.read_record(full)[0]["warc-record-id"]


def test_damage_is_noticed():
    archive = warc.write_archive([warc.write_record(i, "u", f"text {i} ".encode() * 40, None) for i in range(20)])
    assert len(list(warc.read_archive(archive))) == 20
    with pytest.raises(ValueError):
        list(warc.read_archive(archive[:8] + b"??" + archive[9:] + b"junk-junk"))
    with pytest.raises(ValueError):
        warc.read_record(warc.write_record(1, "u", b"abc", None)[:-1])


def test_empty_table(spark):
    _, back = round_trip(spark, spark.createDataFrame([], SCHEMA))
    assert back.count() == 0
    assert back.schema["refers_to"].dataType.simpleString() == "bigint"
    assert back.agg(F.count("payload")).first()[0] == 0
