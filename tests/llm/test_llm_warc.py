import base64
import hashlib
import re
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import SMALL
from ebbline.llm import warc
from ebbline.llm.queries import op3_warc
from ebbline.sources import scratch_path

PAGES = "page_id long, url string, html string, digest string, size int, last long, text string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    groups = {}
    for page_id, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, html in rows:
        own = [i for i in groups[html or ""] if i is not None]
        refers = max(own) if own and len((html or "").encode()) >= least and len(groups[html or ""]) > 1 else None
        revisit = refers is not None and refers != page_id
        out.append((page_id, len((html or "").encode()), digest(html), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows, **settings):
    folder = scratch_path(spark, "test-archives")
    given = spark.createDataFrame([(page_id, f"http://h/{n}\r\nX: y", html, "d", 1, 2, "t") for n, (page_id, html) in enumerate(rows)], PAGES)
    warc.write_archives(given, folder, **settings)
    return warc.read_archives(spark, folder), folder


def columns(found):
    return sorted((tuple(row) for row in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(row.page_id, row.html) for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert columns(op3_warc(spark, SMALL)) == brute(rows)


ODD = [(1, "same"), (2, "same"), (2, "same"), (3, None), (4, ""), (None, "same"), (None, "alone"), (None, "alone"), (5, "é\U0001f600\r\n\r\nWARC/1.1"), (6, "x" * 3_000_000), (7, "x" * 3_000_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_odd_rows_and_many_archives(spark, least):
    found, folder = round_trip(spark, ODD, least_bytes=least, archive_bytes=1000)
    assert columns(found) == brute(ODD, least)
    texts = {row.page_id: bytes(row.payload) for row in found.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert texts[5] == ODD[8][1].encode() and texts[7] == ODD[-1][1].encode() and texts[4] == b""
    assert found.where("url LIKE '%\\r%' OR url NOT LIKE 'http://h/%'").count() == 0


def test_empty_table(spark):
    folder = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_archives(spark, folder).count() == 0


def archive(*records):
    writer = warc.ArchiveWriter([b"some payload to learn from"])
    for one in records:
        writer.add(one)
    return writer.close()


def good(payload=b"<p>hi</p>"):
    return warc.record(1, "http://h/", payload, hashlib.sha1(payload).digest(), None)


def test_archive_layout():
    made = archive(good(), good(b""))
    magic, size = struct.unpack_from("<II", made)
    assert magic == 0x184D2A5D
    held = zstandard.ZstdDecompressor().decompress(made[8 : 8 + size])
    first = warc.frame_end(memoryview(made), 8 + size)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    assert decoder.decompress(made[8 + size : first]) == good()
    assert [warc.read_record(raw)["payload"] for raw in warc.frames(made + warc.EMPTY_FRAME.encode())] == [b"<p>hi</p>", b""]


def test_a_dictionary_is_trained_where_there_is_enough():
    pages = [f"<html><body><div class='page'><p>number {n} {hashlib.md5(str(n).encode()).hexdigest()}</p></div></body></html>".encode() * 3 for n in range(400)]
    assert warc.dictionary_of(pages)[:4] == struct.pack("<I", 0xEC30A437)
    assert warc.dictionary_of([]) == b""


def changed(raw, old, new):
    assert old in raw
    return raw.replace(old, new, 1)


BAD = {
    "no version": lambda raw: changed(raw, b"WARC/1.1", b"WORC/1.1"),
    "no type": lambda raw: re.sub(rb"WARC-Type: [a-z]+\r\n", b"", raw),
    "no id": lambda raw: re.sub(rb"WARC-Record-ID: [^\r]+\r\n", b"", raw),
    "no date": lambda raw: re.sub(rb"WARC-Date: [^\r]+\r\n", b"", raw),
    "no length": lambda raw: re.sub(rb"Content-Length: [^\r]+\r\n", b"", raw),
    "wrong length": lambda raw: re.sub(rb"Content-Length: [0-9]+", b"Content-Length: 7", raw),
    "length not a number": lambda raw: re.sub(rb"Content-Length: [0-9]+", b"Content-Length: -7", raw),
    "header twice": lambda raw: changed(raw, b"WARC-Type: response\r\n", b"WARC-Type: response\r\n" * 2),
    "no colon": lambda raw: changed(raw, b"WARC-Type: response\r\n", b"WARC-Type: response\r\nnothing\r\n"),
    "other payload": lambda raw: changed(raw, b"<p>hi</p>", b"<p>ho</p>"),
    "unknown type": lambda raw: changed(raw, b"WARC-Type: response", b"WARC-Type: metadata"),
    "two records in a frame": lambda raw: raw + raw,
}


@pytest.mark.parametrize("name", BAD)
def test_bad_records_are_refused(name):
    with pytest.raises(warc.BadRecord):
        for raw in warc.frames(archive(BAD[name](good()))):
            warc.read_record(raw)


@pytest.mark.parametrize("cut", [4, 20, -3, -20])
def test_cut_archives_are_refused(cut):
    with pytest.raises(warc.BadRecord):
        list(warc.frames(archive(good())[:cut]))
    with pytest.raises(warc.BadRecord):
        list(warc.frames(b"junk" + archive(good())))


def test_a_damaged_file_ends_the_job(spark):
    rows, folder = round_trip(spark, [(1, "a"), (2, "b")])
    bad = scratch_path(spark, "test-archives")
    whole = spark.read.format("binaryFile").load(folder).select(F.expr("substring(content, 2)").cast("string").alias("value"))
    whole.write.text(bad)
    with pytest.raises(Exception, match="no dictionary frame"):
        warc.read_archives(spark, bad).collect()
