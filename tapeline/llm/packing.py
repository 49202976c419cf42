"""Token sequences packed first-fit decreasing in randomised groups of documents."""

import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.bpe import encode_whole
from tapeline.llm.common import rows_per_batch
from tapeline.sources.staging import staging_path

CAPACITY = 1024
GROUP_DOCS = 2_048
END_ID = 0
SEED = 1


def _byte_of_character() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable
    Latin-1 ones for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _encoding(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoder of a byte-level BPE file whose ids are in order of merges."""
    model = json.loads(vocabulary)
    special = {token["content"] for token in model.get("added_tokens", ())}
    of = _byte_of_character()
    ranks = {bytes(of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _added_tokens(vocabulary: bytes) -> tuple[re.Pattern, dict[str, bytes]] | None:
    """A pattern of the added tokens of a BPE file, longest first, and their ids."""
    added = json.loads(vocabulary).get("added_tokens", ())
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens must be plain strings")
    contents = sorted((t["content"] for t in added), key=len, reverse=True)
    ids = {t["content"]: struct.pack("<I", t["id"]) for t in added}
    return (re.compile("|".join(map(re.escape, contents))), ids) if ids else None


def encoder_with_added(vocabulary: bytes, pattern: str) -> Callable[[str], bytes]:
    """Encodes texts as the ``tokenizers`` library does: added tokens in a text are cut out
    first, and what lies between them is encoded piece by piece.

    To be made once a task: finding the tables in the caches compares whole vocabularies.
    """
    encoding, added = _encoding(vocabulary, pattern), _added_tokens(vocabulary)

    def encode(text: str) -> bytes:
        parts, last = [], 0
        for match in added[0].finditer(text) if added else ():
            parts += [encode_whole(text[last : match.start()], encoding, pattern), added[1][match[0]]]
            last = match.end()
        return b"".join([*parts, encode_whole(text[last:], encoding, pattern)])

    return encode


class CapacityTree:
    """A tournament tree: each node holds the largest free room of the bins below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Put ``size`` in the first bin with room for it, and return that bin."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        chosen = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return chosen


def first_fit_decreasing(sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Bins of whole items (item, from, to), largest items first."""
    tree = CapacityTree(len(sizes), capacity)
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins.setdefault(tree.first_fit(sizes[item]), []).append((item, 0, sizes[item]))
    return [bins[b] for b in sorted(bins)]


def fill_gaps(bins: list[list[tuple[int, int, int]]], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Take the emptiest bins apart to fill the others to the brim.

    Each bin that is filled cuts at most one item. What is left of the last bin is cut
    at powers of two, which need no padding.
    """
    bins = sorted(bins, key=lambda b: -sum(end - start for _, start, end in b))
    free = [capacity - sum(end - start for _, start, end in b) for b in bins]
    full, last = 0, len(bins) - 1
    while full < last:
        if not free[full]:
            full += 1
        elif not bins[last]:
            last -= 1
        else:
            item, start, end = bins[last].pop()
            cut = min(end, start + free[full])
            bins[full].append((item, start, cut))
            free[full] -= cut - start
            if cut < end:
                bins[last].append((item, cut, end))
    whole = bins[:last]
    rest = bins[last] if bins else []
    total = sum(end - start for _, start, end in rest)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part = []
        while size:
            item, start, end = rest.pop()
            cut = min(end, start + size)
            part.append((item, start, cut))
            size -= cut - start
            if cut < end:
                rest.append((item, cut, end))
        whole.append(part)
    return whole


_PIECE = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("ids", pa.binary()),
]
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def _pieces(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str, text_col: str, groups: int, added_tokens: bool
) -> DataFrame:
    """Each document's ids, cut at every CAPACITY; the last piece has a random group."""
    spark = docs.sparkSession
    rows_per_batch(spark)
    vocabulary = spark.sparkContext.broadcast(Path(vocabulary_path).read_bytes())  # bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if added_tokens:
            encode = encoder_with_added(vocabulary.value, pattern)
        else:
            encode = partial(encode_whole, encoding=_encoding(vocabulary.value, pattern), pattern=pattern)
        end = struct.pack("<I", END_ID)
        random = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(encode(text or "") + end, "<u4")
                for start in range(0, len(ids), CAPACITY):
                    piece = ids[start : start + CAPACITY]
                    group = -1 if len(piece) == CAPACITY else int(random.integers(groups))
                    row = (doc_id, start, len(piece), len(ids), piece.tobytes(), group)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            types = [t for _, t in _PIECE] + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                [*(n for n, _ in _PIECE), "pack_group"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = staging_path(spark, "pieces")
    rows = rows.mapInArrow(run, f"{_PIECES}, pack_group long")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _pack_group(key: tuple, rows: pa.Table) -> pa.Table:
    group = key[0].as_py()
    doc_ids, starts, lengths, totals, ids, _ = (c.to_pylist() for c in rows.columns)
    columns: list[list] = [[] for _ in range(7)]
    for number, packed in enumerate(fill_gaps(first_fit_decreasing(lengths))):
        offset = 0
        for item, a, b in packed:
            piece = ids[item][4 * a : 4 * b]
            row = (doc_ids[item], starts[item] + a, b - a, totals[item], piece, 2 * (group << 31 | number), offset)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += b - a
    types = [*_PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64())]
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(types, columns, strict=True)})


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """Sequences of at most CAPACITY tokens, as a row per piece of a document.

    A document's tokens are its ids, in the byte-level BPE file, and END_ID. With
    ``added_tokens``, as the registered queries have it, the file's added tokens in a
    text have their own ids; else their strings are ordinary text. Columns: doc_id, start and length of the piece
    among the document's tokens, doc_tokens, ids (little-endian unsigned 32-bit),
    sequence_id and offset, where the piece begins in its sequence.

    Full stretches of CAPACITY are sequences of their own and are never shuffled. The
    shorter ends of documents go to random groups of about GROUP_DOCS, which are packed
    independently: first-fit decreasing, then gaps are filled from the emptiest bins. A
    group's size doesn't depend on keys, texts or copies. Pieces are written before they
    are shuffled, so random groups are the same when work is done again.
    Null texts are empty (END_ID alone); repeated rows are documents of their own; an
    empty table has no sequences.
    """
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    pieces = _pieces(docs, vocabulary_path, pattern, id_col, text_col, groups, added_tokens)
    names = [n for n, _ in _PIECE]
    full = pieces.filter("pack_group < 0").select(
        *names, (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    ends = pieces.filter("pack_group >= 0").groupBy("pack_group")
    packed = ends.applyInArrow(_pack_group, f"{_PIECES}, sequence_id long, offset long")
    return full.unionByName(packed)
