"""Byte-level BPE: long texts are encoded in overlapping chunks, decoding joins bytes."""

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import rows_per_batch, stage

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
SCAN_CHARS = 1 << 17  # of a text that the library scans in one go
_PLAIN = array("I").itemsize == 4 and sys.byteorder == "little"  # an array is bytes as they are written


@lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    tokens = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in tokens}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=4)
def _pieces(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def boundaries(text: str, pattern: str, is_end: bool) -> list[int]:
    """Where pre-tokens end, from a scan that starts at 0.

    A match that reaches the end of a chunk could have gone on, so it tells nothing
    unless the text ends there as well.
    """
    ends = [m.end() for m in _pieces(pattern).finditer(text)]
    while ends and not is_end and ends[-1] == len(text):
        ends.pop()
    return ends


def _as_bytes(ids: list[int]) -> bytes:
    return (array("I", ids) if _PLAIN else np.array(ids, dtype="<u4")).tobytes()


def encode_whole(text: str, encoding: tiktoken.Encoding, pattern: str) -> bytes:
    """Ids of a text of any length. The library's own scan of white space overflows its
    stack at about half a million characters, so longer texts are split here."""
    if len(text) <= SCAN_CHARS:
        return _as_bytes(encoding.encode_ordinary(text))
    found = _pieces(pattern).findall(text)
    return b"".join(_as_bytes(encoding._encode_single_piece(p.encode())) for p in found)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, little-endian unsigned 32-bit.

    ``ranks_path`` is a vocabulary file in the driver's reach: a line a token, base64
    and rank. Each match of ``pattern`` is encoded by itself; strings of special tokens
    are ordinary text. Texts longer than ``chunk`` characters are cut into chunks that
    share ``overlap`` characters. Chunks are spread over the cluster and scanned for
    pre-token boundaries, each from its own start. A boundary that two neighbours both
    see in their overlap is where they are in step: from there on both see the same. The
    text is cut there, and the pieces are encoded wherever they are. Should an overlap
    hold no common boundary, as within a pre-token longer than it, the whole document
    is scanned and encoded in one piece. The pattern may look ahead, not behind.
    Null and empty texts have no ids; repeated rows come back repeated.
    """
    spark = docs.sparkSession
    rows_per_batch(spark)
    ranks = spark.sparkContext.broadcast(Path(ranks_path).read_bytes())  # a vocabulary: bounded
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            found = [encode_whole(t, encoding, pattern) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, at in enumerate(range(0, len(text), chunk)):
                    part = text[at : at + chunk + overlap]
                    last = at + chunk >= len(text)
                    yield pa.RecordBatch.from_pylist(
                        [{"key": key, "doc_id": doc_id, "k": k, "last": last, "part": part}], batch_schema
                    )

    batch_schema = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32()), ("last", pa.bool_()), ("part", pa.string())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for last, part in zip(*(batch.column(i).to_pylist() for i in (3, 4)), strict=True):
                seen = boundaries(part, pattern, last)
                heads.append([0, *(e for e in seen if e < overlap)])
                tails.append([e - chunk for e in seen if e >= chunk])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                [*batch.schema.names, "heads", "tails"],
            )

    long = rows.filter(F.length("text") > chunk).withColumn("key", F.monotonically_increasing_id())
    chunks = long.select("key", "doc_id", "text").mapInArrow(cut, "key long, doc_id long, k int, last boolean, part string")
    schema = "key long, doc_id long, k int, last boolean, part string, heads array<int>, tails array<int>"
    scanned = stage(chunks.repartition("key", "k").mapInArrow(scan, schema), "chunks")

    order = Window.partitionBy("key").orderBy("k")
    common = F.array_min(F.array_intersect("heads", F.lag("tails").over(order)))
    start = F.when(F.col("k") == 0, F.lit(0)).otherwise(common)
    starts = scanned.select("key", "k", start.alias("start"))
    lost = F.max(F.col("start").isNull()).over(Window.partitionBy("key"))
    cuts = starts.select(
        "key", "k", "start", F.lead("start").over(order).alias("next"), lost.alias("lost")
    )
    cuts = stage(cuts, "cuts")
    parts = scanned.select("key", "k", "doc_id", "last", "part").join(cuts, ["key", "k"])
    end = F.when(F.col("last"), F.length("part")).otherwise(F.col("next") + chunk)
    own = F.when(F.col("last"), F.col("part")).otherwise(F.substring("part", 1, chunk))
    pieces = parts.filter("not lost").select(
        F.struct("key", "doc_id", "k").alias("of"),
        F.substring("part", F.col("start") + 1, end - F.col("start")).alias("text"),
    )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            found = [encode_whole(t, encoding, pattern) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["of", "ids"])

    pieces = pieces.mapInArrow(encode_pieces, "of struct<key:long,doc_id:long,k:int>, ids binary")
    joined = pieces.groupBy("of.key").agg(
        F.first("of.doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("of.k", "ids"))).alias("parts")
    )
    joined = joined.select("doc_id", _concat_binary(F.col("parts.ids")).alias("ids"))
    unsynced = parts.filter("lost").groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("k", own.alias("own")))).alias("parts")
    )
    unsynced = unsynced.select("doc_id", F.array_join("parts.own", "").alias("text"))
    ids = "doc_id long, ids binary"
    short = rows.filter(F.length("text") <= chunk)
    return short.mapInArrow(whole, ids).unionByName(joined).unionByName(unsynced.mapInArrow(whole, ids))


def _concat_binary(parts):
    return F.aggregate(F.slice(parts, 2, F.size(parts)), F.get(parts, F.lit(0)), lambda a, b: F.concat(a, b))


def decode(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) with ``decoded``: the bytes of the ids, put together; null for null."""
    spark = rows.sparkSession
    rows_per_batch(spark)
    ranks = spark.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            found = [
                None if ids is None else encoding.decode_bytes(np.frombuffer(ids, "<u4").tolist())
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["doc_id", "ids", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
