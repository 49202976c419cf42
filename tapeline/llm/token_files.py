"""Token ids in files: ranked by frequency, one to four bytes each, control bytes apart.

A file is a header, the ids in order of rank, and blocks. A block holds up to
BLOCK_TOKENS ids of consecutive documents: the documents that begin in it, control
bytes with two bits for the length of each id, then the bytes of the ids' ranks.
The last block is empty and counts what the file holds.
"""

import json
import struct
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import BinaryIO, NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stage, with_key
from tapeline.llm.packing import encoder_with_added
from tapeline.llm.warc import open_store
from tapeline.sources.staging import staging_path

END_ID = 0
PIECE_TOKENS = 1 << 16
BLOCK_TOKENS = 1 << 16
FILE_TOKENS = 1 << 24
MAX_FILES = 10_000  # beyond, files grow

_MAGIC = b"RANKVB1\n"
_HEADER = struct.Struct("<8sQI")  # magic, ids before the file, size of the vocabulary
_BLOCK = struct.Struct("<IIII")  # ids, bytes of ranks, documents, CRC-32 of what follows
_DOC = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("tokens", "<u8")])
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)  # by control byte
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)  # by length
_SHIFTS = np.array([0, 2, 4, 6], np.uint8)
_READ = 1 << 22  # bytes of rows handed on at once


class FileError(ValueError):
    """A file isn't what its header and blocks say."""


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers; small ones take fewer bytes."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    lengths = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = np.bitwise_or.reduce(codes.reshape(-1, 4) << _SHIFTS, axis=1)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again: lengths from a table by control byte, values cut by a table of masks."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    if len(lengths) < count or (ends[-1] if count else 0) != len(data):
        raise FileError("control bytes and data differ")
    padded = data + bytes(3)
    words = np.ndarray(len(data), "<u4", padded, strides=(1,))  # four bytes from each place
    return words[ends - lengths] & _MASKS[lengths]


class Writer:
    """Writes documents, in order, as blocks; memory holds one block."""

    def __init__(self, out: BinaryIO, start: int, by_rank: np.ndarray):
        self.out, self.tokens, self.docs = out, 0, 0
        self._ranks, self._held, self._new = [], 0, []
        out.write(_HEADER.pack(_MAGIC, start, len(by_rank)) + by_rank.astype("<u4").tobytes())

    def begin(self, doc_id: int | None, tokens: int) -> None:
        if not tokens:
            raise ValueError("a document has at least its end")
        self._new.append((doc_id is not None, doc_id or 0, tokens))
        self.docs += 1

    def add(self, ranks: np.ndarray) -> None:
        """Ids, as ranks, of the document that began last."""
        while len(ranks):
            part = ranks[: BLOCK_TOKENS - self._held]
            self._ranks.append(part)
            self._held += len(part)
            self.tokens += len(part)
            ranks = ranks[len(part) :]
            if self._held == BLOCK_TOKENS:
                self._flush()

    def _flush(self) -> None:
        control, data = pack_ranks(np.concatenate(self._ranks))
        new = np.array(self._new, _DOC).tobytes()
        body = new + control + data
        self.out.write(_BLOCK.pack(self._held, len(data), len(self._new), crc32(body)) + body)
        self._ranks, self._held, self._new = [], 0, []

    def finish(self) -> None:
        if self._held:
            self._flush()
        totals = struct.pack("<QQ", self.tokens, self.docs)
        self.out.write(_BLOCK.pack(0, len(totals), 0, crc32(totals)) + totals)


class Document(NamedTuple):
    doc_id: int | None
    start: int
    tokens: int


def read_file(stream: BinaryIO) -> Iterator[tuple[Document, np.ndarray]]:
    """Each document and its ids, in one part or several; a block is held at once."""

    def take(size: int) -> bytes:
        parts = []
        while size:
            part = stream.read(size)
            if not part:
                raise FileError("the file is cut off")
            parts.append(part)
            size -= len(part)
        return b"".join(parts)

    magic, start, size = _HEADER.unpack(take(_HEADER.size))
    if magic != _MAGIC:
        raise FileError("no file of ranked ids")
    by_rank = np.frombuffer(take(4 * size), "<u4")
    tokens = docs = left = 0
    doc = None
    while True:
        count, data_bytes, new, check = _BLOCK.unpack(take(_BLOCK.size))
        body = take(new * _DOC.itemsize + -(-count // 4) + data_bytes)
        if crc32(body) != check:
            raise FileError("a block is damaged")
        if not count:
            break
        begun = iter(np.frombuffer(body[: new * _DOC.itemsize], _DOC).tolist())
        coded = body[new * _DOC.itemsize :]
        ranks = unpack_ranks(coded[: -(-count // 4)], coded[-(-count // 4) :], count)
        if len(ranks) and int(ranks.max()) >= size:
            raise FileError("a rank beyond the vocabulary")
        ids, at = by_rank[ranks], 0
        while at < count:
            if not left:
                known, doc_id, left = next(begun, (None, None, 0))
                if not left:
                    raise FileError("ids of no document")
                doc = Document(doc_id if known else None, start + tokens, left)
                docs += 1
            part = ids[at : at + left]
            yield doc, part
            at, left, tokens = at + len(part), left - len(part), tokens + len(part)
    if left or stream.read(1) or body != struct.pack("<QQ", tokens, docs):
        raise FileError("the file holds other numbers than it counts")


_PIECES = "key long, doc_id long, piece int, doc_tokens long, ids binary"


def _width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, vocabulary_path: str, pattern: str) -> tuple[DataFrame, str]:
    """Pieces of the ids and END_ID of (key, doc_id, text), and the type of the packed ids.

    Ids are those the ``tokenizers`` library gives for the byte-level BPE file without special
    tokens: its added tokens have their ids wherever a text holds them.
    """
    spark = docs.sparkSession
    content = Path(vocabulary_path).read_bytes()
    vocabulary = spark.sparkContext.broadcast(content)  # bounded
    model = json.loads(content)
    added = [token["id"] for token in model.get("added_tokens", ())]
    width = _width(1 + max([*model["model"]["vocab"].values(), *added]))
    end = struct.pack("<I", END_ID)
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_with_added(vocabulary.value, pattern)
        for batch in batches:
            columns: list[list] = [[] for _ in types]
            for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(encode(text or "") + end, "<u4").astype(width)
                for piece, at in enumerate(range(0, len(ids), PIECE_TOKENS)):
                    row = (key, doc_id, piece, len(ids), ids[at : at + PIECE_TOKENS].tobytes())
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["key", "doc_id", "piece", "doc_tokens", "ids"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(run, _PIECES), width


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = staging_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ids_by_frequency(pieces: DataFrame, width: str) -> np.ndarray:
    """The ids that occur, most frequent first, then smallest; at most a vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            joined = np.frombuffer(b"".join(batch.column(0).to_pylist()), width)
            found = np.bincount(joined, minlength=len(total))
            found[: len(total)] += total
            total = found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = pieces.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    ids, n = found.column("id").to_numpy(), found.column("n").to_numpy()
    return ids[np.lexsort((ids, -n))]


def _ranked(pieces: DataFrame, width: str, by_rank: np.ndarray, bounds: list[int]) -> DataFrame:
    """``pieces`` with the ranks of their ids, and the file they go to."""
    rank_of = np.zeros(int(by_rank.max()) + 1, width)
    rank_of[by_rank] = np.arange(len(by_rank))
    shared = pieces.sparkSession.sparkContext.broadcast((rank_of, bounds))  # a vocabulary and MAX_FILES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks_of, last_keys = shared.value
        for batch in batches:
            files = np.searchsorted(last_keys, batch.column(0).to_numpy()).astype(np.int32)
            ranks = [ranks_of[np.frombuffer(ids, width)].tobytes() for ids in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(files), *batch.columns[:4], pa.array(ranks, pa.binary())],
                ["file", "key", "doc_id", "piece", "doc_tokens", "ranks"],
            )

    return pieces.mapInArrow(run, "file int, key long, doc_id long, piece int, doc_tokens long, ranks binary")


def _file_starts(docs: DataFrame, bounds: list[int]) -> list[int]:
    """How many ids lie before each file; ``docs`` is (key, doc_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            np.add.at(total, np.searchsorted(bounds, batch.column(0).to_numpy()), batch.column(1).to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["file", "tokens"])

    sums = docs.select("key", "doc_tokens").mapInArrow(run, "file long, tokens long").groupBy("file")
    found = dict(sums.agg(F.sum("tokens")).collect())  # a row a file
    return [0, *np.cumsum([found.get(file, 0) for file in range(len(bounds))], dtype=np.int64).tolist()]


LISTED = "path string, start long, tokens long, docs long"


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of ``docs`` as files in ascending order of document; returns their list.

    Texts are encoded once and their ids written, for they are read twice: to rank them by
    how often they occur in all documents, and to be sorted. Files take ranges of documents;
    their bounds are percentiles of the keys, so each holds about the same number of documents.
    Pieces of up to PIECE_TOKENS ids go to their file's task, are sorted there and written as
    a stream, so no row holds a very long document whole. The list (see LISTED) is a table
    that Spark commits: files of tasks that were lost or run twice are not in it.

    A null text is empty (END_ID alone). Documents without id come last; those that share an
    id are in order of text. An empty table has no files. Other columns, however called,
    play no part. ``folder`` must be one that all executors reach.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces, width = encoded(with_key(rows, "key", "doc_id", "text"), vocabulary_path, pattern)
    pieces = _kept(pieces, "ids")
    by_rank = ids_by_frequency(pieces, width)
    if not len(by_rank):
        return spark.createDataFrame([], LISTED)
    firsts = pieces.filter("piece = 0").select("key", "doc_tokens")
    total = firsts.agg(F.sum("doc_tokens")).first()[0]
    files = min(MAX_FILES, -(-total // file_tokens))
    shares = [k / files for k in range(1, files)]
    found = firsts.agg(F.percentile_approx("key", shares, max(10_000, 10 * files))).first()[0] if shares else []
    bounds = sorted(set(found))
    starts = _file_starts(firsts, bounds)
    ranked = _ranked(pieces, width, by_rank, bounds)
    sorted_pieces = ranked.repartitionById(len(starts), "file").sortWithinPartitions("file", "key", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(folder)
        store.create_dir(place, recursive=True)
        current, out, writer, name = None, None, None, ""

        def listed() -> pa.RecordBatch:
            writer.finish()
            out.close()
            row = {"path": f"{folder}/{name}", "start": starts[current], "tokens": writer.tokens, "docs": writer.docs}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for file, _, doc_id, piece, doc_tokens, ranks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != current:
                    if writer:
                        yield listed()
                    current, name = file, f"{file:06d}-{uuid.uuid4().hex}.ids"
                    out = store.open_output_stream(f"{place}/{name}", compression=None)
                    writer = Writer(out, starts[file], by_rank)
                if piece == 0:
                    writer.begin(doc_id, doc_tokens)
                writer.add(np.frombuffer(ranks, width))
        if writer:
            yield listed()

    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("tokens", pa.int64()), ("docs", pa.int64())])
    return stage(sorted_pieces.mapInArrow(run, LISTED), "token-files")


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in listed files (path, ...).

    ``start`` counts the ids before the document in all files; ``ids_crc32`` is that of all its
    ids, little-endian unsigned 32-bit, which ``with_ids`` adds as ``ids``. A task reads a file,
    a block at a time. A file that is cut off or damaged, or that holds other numbers than are
    listed, fails the job, with its path. A list without files has no documents.
    """
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    types = [pa.int64()] * 4 + [pa.binary()] * with_ids

    def documents(path: str, tokens: int, docs: int) -> Iterator[tuple]:
        store, place = open_store(path)
        seen_tokens = seen_docs = 0
        with store.open_input_stream(place, compression=None) as stream:
            check, length, parts = 0, 0, []
            for doc, ids in read_file(stream):
                data = ids.astype("<u4").tobytes()
                check, length = crc32(data, check), length + len(ids)
                if with_ids:
                    parts.append(data)
                if length == doc.tokens:
                    row = (doc.doc_id, doc.start, doc.tokens, check)
                    yield (*row, b"".join(parts)) if with_ids else row
                    seen_tokens, seen_docs = seen_tokens + length, seen_docs + 1
                    check, length, parts = 0, 0, []
        if (seen_tokens, seen_docs) != (tokens, docs):
            raise FileError("the file isn't the listed one")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for listed in batch.to_pylist():
                rows, held = [], 0
                try:
                    for row in documents(listed["path"], listed["tokens"], listed["docs"]):
                        rows.append(row)
                        held += 64 + (row[2] * 4 if with_ids else 0)
                        if held >= _READ:
                            yield batch_of(rows)
                            rows, held = [], 0
                except FileError as error:
                    raise FileError(f"{listed['path']}: {error}") from error
                if rows:
                    yield batch_of(rows)

    result = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    # a file a task: they are large, and their list is short, so Spark would gather them
    tasks = max(1, min(files.count(), MAX_FILES))
    return files.select("path", "tokens", "docs").repartition(tasks).mapInArrow(run, result)
