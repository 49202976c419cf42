"""Importance resampling: documents drawn by how much like a target corpus they read."""

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import fresh, stage, with_key

BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
_SPACE = 0x20
_AT_ONCE = 1 << 16  # spans counted at once

#: UTF-8 bytes: A-Z to a-z; those outside of words, which are all ASCII, to spaces
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE
    for b in range(256)
)


def collapsed(text: str) -> bytes:
    """The words of a text in UTF-8, A-Z lower-cased, with one space between them."""
    data = np.frombuffer(text.encode().translate(_FOLD), np.uint8)
    keep = data != _SPACE
    keep[1:] |= keep[:-1].copy()  # a space stays after a word
    return data[keep].tobytes().rstrip(b" ")


def gram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words; the lookarounds let a run begin and end only with a whole word."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def spans(words: bytes, n: int) -> Iterator[tuple[int, int]]:
    """Where the runs of ``n`` words lie in collapsed text, also where they overlap."""
    return (m.span() for m in gram_pattern(n).finditer(words, overlapped=True))


def bucket_ids(words: bytes, min_n: int, max_n: int, buckets: int) -> np.ndarray:
    """The bucket of each feature: the unsigned CRC-32 of its bytes, modulo ``buckets``.

    Spans are counted by the thousand as the scan emits them, so besides the text memory
    holds a few bytes for each feature.
    """
    parts = []
    for n in range(min_n, max_n + 1):
        found = (crc32(words[a:b]) for a, b in spans(words, n))
        while len(some := np.fromiter((h for h, _ in zip(found, range(_AT_ONCE), strict=False)), np.uint32)):
            parts.append((some % buckets).astype(_type_of(buckets)))
    return np.concatenate(parts) if parts else np.empty(0, _type_of(buckets))


def _type_of(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


_HASHED = "key long, id long, n_words long, n_features long, buckets binary"


def hashed(docs: DataFrame, min_n: int, max_n: int, buckets: int) -> DataFrame:
    """(key, id, n_words, n_features, buckets) of (key, id, text): a text is scanned once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features, found = [], [], []
            for text in batch.column(2).to_pylist():
                words = collapsed(text or "")
                ids = bucket_ids(words, min_n, max_n, buckets)
                counts.append(words.count(b" ") + 1 if words else 0)
                features.append(len(ids))
                found.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(counts, pa.int64()), pa.array(features, pa.int64()), pa.array(found, pa.binary())],
                ["key", "id", "n_words", "n_features", "buckets"],
            )

    return docs.select("key", "id", "text").mapInArrow(run, _HASHED)


def _flat(column: pa.BinaryArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed numbers, and where each row's begin (and the end)."""
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, kind), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind)
    return flat, (ends - ends[0]) // flat.itemsize


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows lie in each bucket; tasks hand on one count a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), _type_of(buckets))[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket")
    found = counts.agg(F.sum("n").alias("n")).toArrow()  # at most a row a bucket
    total = np.zeros(buckets, np.int64)
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the corpus."""
    buckets, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    found = [
        math.floor(1000 * math.log((t + 1) * (all_raw + buckets) / ((s + 1) * (all_target + buckets))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ]
    return np.array(found, np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(key, id, n_words, n_features, weight): the sum of the gains of a document's features."""
    bucket_type = _type_of(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ends = _flat(batch.column(4), bucket_type)
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(gain[ids])])[ends]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.diff(sums))], ["key", "id", "n_words", "n_features", "weight"]
            )

    return rows.mapInArrow(run, "key long, id long, n_words long, n_features long, weight long")


def gumbel(id_: Column, seed: int) -> Column:
    """A document's own draw, floor(1000 * -ln(-ln(u))); u comes from the digest of its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def _positions(rows: DataFrame) -> DataFrame:
    """``rows``, sorted and written, with their ``position`` from 1.

    Sorted partitions are numbered apart; how many rows lie before each is known from a
    count of each partition, so no task sees more than its own range.
    """
    ordered = stage(rows.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    counts = sorted(ordered.groupBy(part.alias("part")).count().collect())  # a row a partition
    before, firsts = 0, []
    for number, count in counts:
        firsts.append((number, before))
        before += count
    firsts = rows.sparkSession.createDataFrame(firsts, "part long, before long")
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    found = ordered.withColumn("part", part).join(firsts, "part")
    return found.withColumn("position", F.col("before") + inside).drop("part", "before", "at")


def _ranks(
    docs: DataFrame,
    target: DataFrame,
    min_n: int = 1,
    max_n: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The ranks of (key, id, text) against ``target`` (key, id, text)."""
    found = stage(hashed(docs, min_n, max_n, buckets), "hashed")
    aim = histogram(hashed(target, min_n, max_n, buckets), buckets)
    scored = weighted(found, gains(histogram(found, buckets), aim))
    scored = stage(scored.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scored")
    fits = F.col("n_words") >= min_words
    drawn = percent * scored.filter(fits).count() // 100
    placed = _positions(scored.sort(fits.desc(), F.desc("score"), "key"))
    rank = F.when(F.col("position") <= drawn, F.col("position"))
    return placed.select("key", "id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def _texts(rows: DataFrame, key: Column, id_: Column, text_col: str) -> DataFrame:
    return rows.select(key.cast("long").alias("key"), id_.cast("long").alias("id"), F.col(text_col).alias("text"))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    **options: int,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z
    lower-cased. Features are the runs of ``min_n`` to ``max_n`` words, found by an
    overlapped scan of the text with single spaces, hashed into ``buckets``. A bucket's
    gain tells how much more of ``target`` than of ``docs`` lies in it; a document's
    weight is the sum of the gains of its features. The score adds the document's own
    Gumbel draw (of ``seed`` and id), so the highest ``percent`` of those with
    ``min_words`` are a sample without replacement by weight; these have a ``rank``, from
    1. Ties go to the smaller id, then to the smaller text.

    Texts are scanned once; the buckets are written, two bytes a feature, and read for the
    counts and again for the weights. Counts are bounded by ``buckets``. Only narrow rows
    are sorted, by ranges, and numbered range by range.

    A null text has no words, weight 0 and no rank; a null id draws as an empty one. A very
    long text is scanned in one task, in memory of a few times its size. Repeated rows
    stand for themselves. An empty table has no rows; of an empty target nothing is known,
    so gains tell only what is common in ``docs``. Other columns, however called, play no part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    none = F.lit(0)
    ranks = _ranks(with_key(rows, "key", "id", "text"), _texts(target, none, none, target_text_col), **options)
    return ranks.drop("key").withColumnRenamed("id", "doc_id")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    **options: int,
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns; see :func:`importance_ranks`."""
    key, none = fresh(docs, "_draw"), F.lit(0)
    keyed = with_key(docs, key, id_col, text_col)
    rows = _texts(keyed, F.col(key), F.col(id_col), text_col)
    ranks = _ranks(rows, _texts(target, none, none, target_text_col), **options)
    drawn = ranks.filter("rank is not null").select(F.col("key").alias(key))
    return keyed.join(drawn, key, "left_semi").select(*docs.columns)
