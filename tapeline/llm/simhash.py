"""SimHash near-duplicates through segment bit counts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import fresh, rows_per_batch, stage, with_key
from tapeline.llm.graph import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENT_BITS = 2
SPREAD_ROWS = 16_384  # fingerprints that one task spreads over their cells, about fifty each
CELL_LIMIT = 16  # fingerprints in a cell that are compared pair by pair
_HASHES = 1 << 16  # hashes unpacked to bits at once


def fingerprint(text: str | None, n_words: int = SHINGLE_WORDS) -> int:
    """64 bits; one is set if it is set in over half the hashes of the word shingles.

    A-Z are lower-cased and words end at ASCII white space. Fewer words than a shingle
    has are one shingle; a text without words, or null, gives zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(n_words, len(words))
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _HASHES):
        octets = hashes[at : at + _HASHES].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, n_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row of ``docs``, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, n_words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    rows_per_batch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def bit_counts(fp: Column) -> Column:
    """The bits set in each segment of two, in the place of the segment."""

    def counted(half: Column) -> Column:  # of 32 bits, so that no sum reaches the sign
        return half.bitwiseAND(F.lit(0x55555555)) + F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))

    low = counted(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.shiftleft(counted(F.shiftrightunsigned(fp, 32)), 32).bitwiseOR(low)


def _near_counts(counts: Column) -> Column:
    """A grid cell and those one step away from it in one segment.

    Of the two bits of a count, flipping the lower one steps between 0 and 1, flipping both
    between 1 and 2.
    """
    steps = [counts]
    for at in range(0, 64, SEGMENT_BITS):
        here = F.shiftrightunsigned(counts, at).bitwiseAND(F.lit(3))
        steps.append(F.when(here < 2, counts.bitwiseXOR(F.lit(_signed(1 << at)))))
        steps.append(F.when(here > 0, counts.bitwiseXOR(F.lit(_signed(3 << at)))))
    return F.array_compact(F.array(*steps))


def _near_bits(fp: Column) -> Column:
    """A fingerprint and those one bit away."""
    return F.array(fp, *[fp.bitwiseXOR(F.lit(_signed(1 << at))) for at in range(64)])


def _spread(rows: DataFrame, name: str, near, times: int) -> DataFrame:
    """Replace ``name`` by all values at most ``times`` steps away."""
    for _ in range(times):
        rows = rows.withColumn(name, F.explode(near(F.col(name))))
    return rows.distinct() if times > 1 else rows


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` at most ``max_bits`` apart.

    The Manhattan distance of two bit-count vectors is at most the number of bits in
    which the fingerprints differ. So two within ``max_bits`` share a grid cell at most
    half that many steps from either. Those that meet in a cell are compared exactly.
    With segments of two bits random fingerprints fall into about 2**48 cells, so crowded
    ones are rare among any number of texts that differ. A crowded cell would take as many comparisons as its size squared; its
    fingerprints meet instead at the bit patterns half the distance away, which are
    exact meeting points with few members each, and link to the smallest one there.
    So links of crowded cells are not all pairs, but connect the same fingerprints.
    ``max_bits`` is even: two steps to a meeting point are then never too many.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    steps = max_bits // 2
    prints = stage(prints.select("fp"), "fingerprints")
    # each row becomes about fifty, which its bytes don't tell
    prints = prints.repartition(max(1, -(-prints.count() // SPREAD_ROWS)))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    cells = _spread(prints.select("fp", bit_counts(F.col("fp")).alias("cell")), "cell", _near_counts, steps)
    crowds = cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    crowds = stage(crowds.filter("n > 1"), "cells")
    twos = crowds.filter("n = 2").filter(close).select("a", "b")

    members = cells.join(crowds.filter("n > 2").select("cell", "n"), "cell")
    members = stage(members, "members")
    few = members.filter(F.col("n") <= cell_limit).groupBy("cell").agg(F.collect_list("fp").alias("fps"))

    def partners(a: Column) -> Column:
        near = F.filter("fps", lambda b: (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits))
        return F.transform(near, lambda b: F.struct(a.alias("a"), b.alias("b")))

    pairs = few.select(F.explode(F.flatten(F.transform("fps", partners))).alias("pair"))

    many = members.filter(F.col("n") > cell_limit).select("fp").distinct()
    meeting = _spread(many.select("fp", F.col("fp").alias("at")), "at", _near_bits, steps)
    hub = F.min("fp").over(Window.partitionBy("at"))
    stars = meeting.select(hub.alias("a"), F.col("fp").alias("b")).filter("a <> b")
    return twos.unionByName(pairs.select("pair.a", "pair.b")).unionByName(stars).distinct()


def simhash_groups(
    docs: DataFrame,
    n_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) of every row: its near-duplicate group's smallest id.

    Documents link if their fingerprints differ in at most ``max_bits`` bits, and links
    chain. Equal fingerprints are one node, so copies are never compared. Null and
    empty texts have fingerprint zero and link like any other; a null id is never the
    smallest unless all ids of a group are null; repeated rows come back repeated.
    """
    prints = stage(fingerprints(docs, n_words, id_col, text_col), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(near_links(nodes.select("fp"), max_bits))
    nodes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = stage(nodes.select("fp", "least", F.coalesce("root", "fp").alias("root")), "nodes")
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(nodes.select("fp", "root").join(smallest, "root").drop("root"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def one_per_group(
    docs: DataFrame,
    n_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without near-duplicates: the row with the smallest id of each group stays.

    Among rows that share this id the first by text stays; null ids come last.
    """
    key = fresh(docs, "_key")
    keyed = with_key(docs, key, id_col, text_col)
    groups = simhash_groups(keyed, n_words, max_bits, key, text_col)
    least = groups.filter("doc_id = component_id").select(F.col("doc_id").alias(key))
    return keyed.join(least, key, "left_semi").select(docs.columns)
