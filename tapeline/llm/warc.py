"""WARC archives in Zstandard: a frame a record, the dictionary in a leading frame."""

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import rows_per_batch, stage
from tapeline.sources.staging import staging_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
READ_TASKS = 10_000
LEVEL = 3
#: the dictionary is trained on this bounded sample, the only thing that is fitted
SAMPLE_PAGES = 400
SAMPLE_CHARS = 8_192
DICTIONARY_BYTES = 32_768
DATE = "2000-01-01T00:00:00Z"

#: fixed values of the formats
_DICTIONARY_FRAME = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_READ = 1 << 20


class ArchiveError(ValueError):
    """An archive or a record that isn't as its headers say."""


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri[:7] != "file://" and uri[:6] == "file:/" else uri)


def record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None) -> bytes:
    """One WARC record: an HTTP response, or its header alone for a revisit."""
    payload = (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join(c if c > " " else f"%{ord(c):02X}" for c in url or ""),
        "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        headers["WARC-Refers-To"] = _urn(refers_to)
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n") if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse(data: bytes) -> dict:
    """The fields of a record, after checks of its version, headers, lengths and digest."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or not version.startswith(b"WARC/1."):
        raise ArchiveError("no WARC header")
    headers = _headers(lines)
    for name in _REQUIRED:
        if name.lower() not in headers:
            raise ArchiveError(f"no {name}")
    if not headers["content-length"].isdecimal():
        raise ArchiveError("Content-Length is no number")
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length is {length}, the block has {len(rest) - 4}")
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ArchiveError("no HTTP header in the block")
    size = _headers(http.partition(b"\r\n")[2]).get("content-length", "")
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and (size != str(len(payload)) or hashlib.sha256(payload).hexdigest() != digest):
        raise ArchiveError("the payload isn't that of the headers")
    if not size.isdecimal() or kind not in ("response", "revisit"):
        raise ArchiveError("no payload length or record type")
    return {
        "page_id": _page_id(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": int(size),
        "payload_digest": digest,
        "refers_to": _page_id(headers.get("warc-refers-to")),
        "payload": payload.decode() if kind == "response" else None,
    }


def frames(stream: BinaryIO) -> Iterator[bytes]:
    """What each frame of an archive holds, a frame at a time."""
    left = stream.read(_READ)
    dictionary = None
    if len(left) >= 8 and struct.unpack("<I", left[:4])[0] == _DICTIONARY_FRAME:
        (size,) = struct.unpack("<I", left[4:8])
        while len(left) < 8 + size and (more := stream.read(_READ)):
            left += more
        content, left = left[8 : 8 + size], left[8 + size :]
        if len(content) < size:
            raise ArchiveError("the dictionary frame is cut off")
        if content.startswith(_ZSTD_MAGIC):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while left or (left := stream.read(_READ)):
        while len(left) < 8 and (more := stream.read(_READ)):
            left += more
        magic = struct.unpack("<I", left[:4])[0] if len(left) >= 8 else 0
        if magic in _SKIPPABLE:
            (size,) = struct.unpack("<I", left[4:8])
            while len(left) < 8 + size and (more := stream.read(_READ)):
                left += more
            left = left[8 + size :]
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not left and not (left := stream.read(_READ)):
                raise ArchiveError("the last frame is cut off")
            try:
                parts.append(frame.decompress(left))
            except zstandard.ZstdError as error:
                raise ArchiveError(f"no frame: {error}") from error
            left = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to train on."""
    start = F.substring(html_col, 1, SAMPLE_CHARS)
    sample = pages.filter(F.length(html_col) > 0).select(start.alias("html")).limit(SAMPLE_PAGES)
    texts = [row.html.encode() for row in sample.collect()]  # at most SAMPLE_PAGES * SAMPLE_CHARS
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to: the page that has the same payload first.

    That is the one with the smallest page_id of those with equal payloads of at least
    ``min_bytes``; it refers to none itself, nor does a row that repeats its id. A page
    without id comes last, and without another to refer to is a response.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.withColumn("digest", F.when(F.octet_length(payload) >= min_bytes, F.sha2(payload, 256)))
    firsts = rows.filter("digest is not null").groupBy("digest")
    firsts = firsts.agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1")
    rows = rows.join(stage(firsts.select("digest", "first"), "payloads"), "digest", "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, dictionary: bytes = b"", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write (page_id, url, html, refers_to) as archives; returns their list (path, records).

    Each task writes archives of about ``archive_bytes`` under names of their own. The
    list is a table that Spark commits, so files of tasks that were lost or run twice
    are not in it. ``folder`` must be one that all executors reach.
    """
    rows_per_batch(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        content = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=content)
        out, name, size, count = None, "", 0, 0
        store.create_dir(path, recursive=True)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    if dictionary:
                        out.write(struct.pack("<II", _DICTIONARY_FRAME, len(dictionary)) + dictionary)
                data = compressor.compress(record(*row))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield _listed(f"{folder}/{name}", count)
        if out is not None:
            out.close()
            yield _listed(f"{folder}/{name}", count)

    def _listed(path: str, records: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": path, "records": records}], schema)

    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])
    rows = pages.select("page_id", "url", "html", "refers_to")
    return stage(rows.mapInArrow(run, "path string, records long"), "archives")


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string, error string"


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of listed archives (path), as the columns of RECORD.

    Archives are read as streams, so memory holds one record at a time. A record that
    fails a check is a row with ``error`` alone; so is an archive from the place where it
    can't be read on, or one that holds another number of records than is listed.
    """
    with_count = "records" in archives.columns
    rows = archives.select("path", *(["records"] if with_count else []))
    names = [part.split()[0] for part in RECORD.split(", ")]
    types = [pa.string() if part.endswith("string") else pa.int64() for part in RECORD.split(", ")]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def read(path: str, expected: int | None) -> Iterator[dict]:
        store, name = open_store(path)
        count = 0
        try:
            with store.open_input_stream(name, compression=None) as stream:
                for data in frames(stream):
                    count += 1
                    try:
                        yield parse(data)
                    except (ArchiveError, UnicodeDecodeError) as error:
                        yield {"error": f"{path}, record {count}: {error}"}
        except ArchiveError as error:
            yield {"error": f"{path}, after record {count}: {error}"}
        else:
            if expected is not None and count != expected:
                yield {"error": f"{path}: {count} records, {expected} are listed"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, size = [], 0
                for item in read(row["path"], row.get("records")):
                    found.append(item)
                    size += len(item.get("payload") or "")
                    if len(found) >= 256 or size >= _READ:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    # an archive a task: they are large, and their list is short, so Spark would gather them
    tasks = max(1, min(rows.count(), READ_TASKS))
    return rows.repartition(tasks).mapInArrow(run, RECORD)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and read them back; see RECORD for the columns.

    Null html is an empty payload and null url an empty one; a null page_id comes back
    null. Repeated rows make repeated records, and an empty table makes no archive.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    folder = folder or staging_path(pages.sparkSession, "warc")
    return read_archives(write_archives(revisits(rows), folder, train_dictionary(rows)))
