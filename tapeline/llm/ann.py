"""Nearest neighbours by cosine: randomly rotated one-bit codes, then exact reranking."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import stage

QUERY_BLOCK = 256
CANDIDATE_BLOCK = 4_096
QUERY_BITS = 8
BOUND_WIDTH = 2.5  # of the error bound, in units of its scale; more finds more and reranks more
SEED = 20


def valid_vector(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bit a rotated component, packed in 64-bit words, and the correction scalars.

    A code stands for the unit vector of its signs; the scalar is the inner product of
    that with the rotated unit vector itself.
    """
    dim = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(dim)
    octets = np.packbits(turned > 0, axis=1, bitorder="little")
    padded = np.zeros((len(octets), -(-octets.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : octets.shape[1]] = octets
    return padded.view("<u8"), np.abs(turned).sum(axis=1) / np.sqrt(dim)


def estimate(packed: np.ndarray, scalars: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cosines, error bounds), each queries x candidates, from bits and scalars alone.

    Rotated queries are rounded to QUERY_BITS bits a component, so that the inner
    product with a code is a sum of bit counts. The bound is that of the code, which
    falls with the root of the dimension, and that of the rounding.
    """
    dim = queries.shape[1]
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turned = unit @ rotation(dim)
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum(turned.max(axis=1, keepdims=True) - low, 1e-12) / (2**QUERY_BITS - 1)
    levels = np.rint((turned - low) / step).astype(np.uint16)
    sums = np.zeros((len(queries), len(packed)))
    for bit in range(QUERY_BITS):
        plane = np.packbits((levels >> bit) & 1, axis=1, bitorder="little")
        padded = np.zeros((len(plane), packed.shape[1] * 8), dtype=np.uint8)
        padded[:, : plane.shape[1]] = plane
        words = padded.view("<u8")
        for at in range(packed.shape[1]):
            sums += np.bitwise_count(words[:, at, None] & packed[None, :, at]).astype(np.float64) * (1 << bit)
    ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
    # signs are 2 * bit - 1 and components low + step * level
    product = 2 * (step * sums + low * ones[None, :]) - (step * levels.sum(axis=1, keepdims=True) + low * dim)
    rounding = np.abs(turned - (low + step * levels)).sum(axis=1, keepdims=True) / np.sqrt(dim)
    spread = np.sqrt(np.maximum(1 - scalars**2, 0) / max(dim - 1, 1))
    found = product / np.sqrt(dim) / scalars[None, :]
    return found, (BOUND_WIDTH * spread[None, :] + rounding) / scalars[None, :]


def search_block(packed, scalars, vectors, ids, queries, k) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, exact cosines) of the k best rows for each query, ties to smaller ids.

    The k rows with the best estimates are scored exactly; the worst of those scores is
    what others have to reach, so each row whose bound allows it is scored as well.
    """
    found, bound = estimate(packed, scalars, queries)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    k = min(k, len(vectors))
    for at, query in enumerate(queries):
        norm = np.sqrt((query * query).sum())
        first = np.argpartition(-found[at], k - 1)[:k]
        least = ((vectors[first] * query).sum(axis=1) / (norms[first] * norm)).min()
        rows = np.flatnonzero(found[at] + bound[at] >= least)
        rows = np.union1d(rows, first)
        scores = (vectors[rows] * query).sum(axis=1) / (norms[rows] * norm)
        best = np.lexsort((ids[rows], -scores))[:k]
        yield at, rows[best], scores[best]


def nearest(
    embeddings: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of each query row.

    ``queries`` is a condition on ``embeddings``. All its rows, in blocks, meet the
    one-bit codes of all other rows, in blocks; no block grows with the input.
    Score is the cosine of the vectors as given, in double precision; ties go to
    smaller ids. Equal vectors are one candidate that lists its smallest k + 1 ids, and
    equal queries are searched once, so copies, however many, cost nothing more.
    Rows without id, and vectors that are null, zero or hold null or non-finite
    components, take no part; a row that repeats id and vector counts once; rows of one
    id are never each other's neighbours. Vectors only meet those of their length. An empty
    table has no rows; other columns, however called, play no part.
    """
    vec = F.col(vector_col).cast("array<double>")
    rows = embeddings.filter(F.col(id_col).isNotNull() & valid_vector(vec))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))

    order = Window.partitionBy("vec").orderBy("id")
    ranked = rows.select("id", "vec").withColumn("r", F.dense_rank().over(order)).filter(F.col("r") <= k + 1)
    classes = ranked.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    classes = stage(
        classes.select(F.monotonically_increasing_id().alias("class"), "vec", "ids", F.size("vec").alias("dim")),
        "vectors",
    )
    asked = rows.filter("asks").select("id", "vec").distinct()
    asked = stage(asked.join(classes, "vec").select(F.col("id").alias("query_id"), "class"), "queries")
    asking = classes.join(asked.select("class").distinct(), "class")

    def blocks(part: DataFrame, size: int, *more: str) -> DataFrame:
        counts = part.groupBy("dim").agg(F.ceil(F.count("*") / size).alias("n"))
        numbered = part.join(stage(counts, "blocks"), "dim")
        block = F.pmod(F.xxhash64("class"), F.col("n"))
        row = F.struct("class", "vec", *more)
        return numbered.groupBy("dim", block.alias("block")).agg(F.collect_list(row).alias("rows"), F.first("n").alias("n"))

    candidates = blocks(classes, CANDIDATE_BLOCK, "ids").select("dim", "block", "n", "rows")
    coded = stage(candidates.mapInArrow(_encode_blocks, _CODED), "codes")
    asking = blocks(asking, QUERY_BLOCK).select("dim", F.col("rows").alias("asking"))
    last = stage(coded.groupBy("dim").agg(F.max("block").alias("last")), "block-counts")  # a row a length
    block = F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("block")
    pairs = asking.join(last, "dim").select("dim", "asking", block).join(coded, ["dim", "block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            yield _search_pair(row, k + 1)

    found = pairs.select("dim", "asking", "classes", "ids", "packed", "scalars", "vectors")
    found = found.mapInArrow(search, "class long, score double, ids array<long>")
    found = stage(found, "found")
    best = Window.partitionBy("class").orderBy(F.desc("score"), "id")
    found = found.select("class", "score", F.explode("ids").alias("id")).withColumn("r", F.row_number().over(best))
    near = found.filter(F.col("r") <= k + 1).select("class", "score", F.col("id").alias("vec_id"))
    near = asked.join(near, "class").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_CODED = (
    "dim int, block long, classes binary, ids array<array<long>>, packed binary, scalars binary, vectors binary"
)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows that are whole blocks, one at a time as Python values."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _one_by_one(batches):
        vectors = np.array([r["vec"] for r in row["rows"]], dtype=np.float64)
        packed, scalars = codes(vectors)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["dim"]], pa.int32()),
                pa.array([row["block"]], pa.int64()),
                pa.array([np.array([r["class"] for r in row["rows"]], "<i8").tobytes()], pa.binary()),
                pa.array([[r["ids"] for r in row["rows"]]], pa.list_(pa.list_(pa.int64()))),
                pa.array([packed.tobytes()], pa.binary()),
                pa.array([scalars.tobytes()], pa.binary()),
                pa.array([vectors.tobytes()], pa.binary()),
            ],
            ["dim", "block", "classes", "ids", "packed", "scalars", "vectors"],
        )


def _search_pair(row: dict, k: int) -> pa.RecordBatch:
    scalars = np.frombuffer(row["scalars"], np.float64)
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(scalars), -1)
    packed = np.frombuffer(row["packed"], "<u8").reshape(len(scalars), -1)
    least = np.array([ids[0] for ids in row["ids"]])
    queries = np.array([r["vec"] for r in row["asking"]], dtype=np.float64)
    classes, scores, ids = [], [], []
    for at, rows, found in search_block(packed, scalars, vectors, least, queries, k):
        classes += [row["asking"][at]["class"]] * len(rows)
        scores += found.tolist()
        ids += [row["ids"][i] for i in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(classes, pa.int64()), pa.array(scores, pa.float64()), pa.array(ids, pa.list_(pa.int64()))],
        ["class", "score", "ids"],
    )
