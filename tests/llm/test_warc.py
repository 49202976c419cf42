import hashlib
import io
import struct
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from tapeline.llm import warc

SCHEMA = "page_id long, url string, html string, key string"


def brute(rows):
    firsts = {}
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page_id is not None:
            firsts[payload] = min(page_id, firsts.get(payload, page_id))
    out = []
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        first = firsts.get(payload, page_id)
        again = first != page_id
        kind = ("revisit", first) if again else ("response", None)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), *kind))
    return sorted(out, key=repr)


def test_round_trip(spark):
    page = "<p>é &amp; text</p>" * 20
    rows = [(5, "http://a.b/\r\nc", page, ""), (2, None, page, ""), (9, "u", page, ""), (9, "u", page, "")]
    rows += [(3, "u", None, ""), (4, "u", "", ""), (6, "u", "tiny", ""), (7, "u", "tiny", ""), (None, "u", page, "")]
    rows += [(2, None, page, ""), (None, None, None, None), (11, "u", "x" * 3_000_000, "")]
    found = warc.archived(spark.createDataFrame(rows, SCHEMA))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr) == brute(rows)
    assert found.filter("error is not null").count() == 0
    payloads = {(r.page_id, r.payload) for r in found.filter("record_type = 'response'").collect()}
    assert (2, page) in payloads and (3, "") in payloads
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_of_limited_size_with_a_dictionary(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>page {i}</p>" * 40) for i in range(300)], "page_id long, url string, html string")
    dictionary = warc.train_dictionary(pages)
    assert dictionary
    rows = pages.withColumn("refers_to", F.lit(None).cast("long"))
    listed = warc.write_archives(rows, f"file://{tmp_path}/a", dictionary, 2000)
    assert listed.count() > 8 and listed.agg(F.sum("records")).first()[0] == 300
    assert warc.read_archives(listed).filter("error is null").count() == 300
    some = listed.first().path.removeprefix("file://")
    assert struct.unpack("<II", open(some, "rb").read(8)) == (0x184D2A5D, len(dictionary))
    short = listed.withColumn("records", F.col("records") + 1)
    assert warc.read_archives(short).filter("error like '%are listed'").count() == listed.count()


def archive(*records, dictionary=b"", packed=False):
    content = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(dict_data=content)
    head = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    frame = struct.pack("<II", 0x184D2A5D, len(head)) + head if dictionary else b""
    return frame + b"".join(map(compressor.compress, records))


def test_frames():
    records = [warc.record(i, "u", f"<p>{i}</p>" * i, None) for i in range(300)]
    dictionary = zstandard.train_dictionary(1000, records).as_bytes()
    for packed in (False, True):
        data = archive(*records, dictionary=dictionary, packed=packed)
        assert list(warc.frames(io.BytesIO(data))) == records
    extra = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert list(warc.frames(io.BytesIO(archive(records[0]) + extra + archive(records[1])))) == records[:2]
    assert list(warc.frames(io.BytesIO(b""))) == []
    for broken in (archive(*records)[:-3], archive(records[0]) + b"junk in place", data[:500]):
        with pytest.raises(warc.ArchiveError):
            list(warc.frames(io.BytesIO(broken)))


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WRAC/1.1"), (b"WARC-Date", b"WARC-Dote"), (b"Content-Length: 8", b"Content-Length: 9"),
        (b"Content-Length: 8", b"Content-Length: x"), (b"sha256:", b"sha256:0"), (b"HTTP/1.1", b"FTP"),
        (b"response\r\n", b"metadata\r\n"), (b"<p>hi</p>", b"<p>ho</p>"),
    ],
)
def test_records_that_are_not_as_they_say(old, new, spark, tmp_path):
    good = warc.record(1, "u", "<p>hi</p>", None)
    assert warc.parse(good)["payload"] == "<p>hi</p>" and old in good
    bad = good.replace(old, new, 1)
    with pytest.raises(warc.ArchiveError):
        warc.parse(bad)
    if old == b"WARC-Date":
        path = tmp_path / f"{uuid.uuid4().hex}.warc.zst"
        path.write_bytes(archive(good, bad, good))
        rows = warc.read_archives(spark.createDataFrame([(str(path),)], "path string")).collect()
        assert [r.page_id for r in rows] == [1, None, 1] and "record 2" in rows[1].error
