"""Whitened embeddings: covariances from exact variances of dimensions and of their sums."""

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm.common import stage

SCALE = 256
COMPONENTS = 4
_CELLS = 1 << 20  # entries that a task computes with at once
_SMALL = 1 << 20  # entries up to here have 64-bit sums of squares in any block
_DIGITS = 32  # bits of a part of an exact sum
_PARTS = "size int, i int, j int, power int, digits long"
_PART_SCHEMA = pa.schema(
    [("size", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("power", pa.int32()), ("digits", pa.int64())]
)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as ``floor(256 * entry)``, without the rows that can't take part.

    Those are null vectors and vectors with a null, infinite or NaN entry. An entry too
    large for a long becomes the nearest long. Rows are kept as they are, repeated ones too.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.filter(F.col("v").isNotNull() & ~odd).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x")
    )


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a column as matrices of one width, with the rows they came from."""
    offsets, entries = column.offsets.to_numpy(), column.values.to_numpy()
    widths = np.diff(offsets)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        step = max(1, _CELLS // max(1, int(width)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield some, entries[offsets[some][:, None] + np.arange(width)]


def _shifted(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """``x - middle``: in longs where no sum of squares can overflow, else in Python's integers."""
    if not x.size:
        return x
    reach = max(abs(int(x.min())), abs(int(x.max()))) + max(abs(int(m)) for m in middle)
    if reach <= _SMALL:
        return x - middle.astype(np.int64)
    return x.astype(object) - middle


def _squares(z: np.ndarray) -> np.ndarray:
    """Sums of squares of each column of ``z`` (on the diagonal) and of each pair's sum."""
    width, total = z.shape[1], np.zeros((z.shape[1],) * 2, object)
    columns = np.ascontiguousarray(z.T)
    for i in range(width):
        sums = columns[i:] + columns[i]
        sums[0] = columns[i]
        total[i, i:] = (sums * sums).sum(axis=1)
    return total


def _exact_sums(rows: DataFrame, of_block) -> dict[int, np.ndarray]:
    """``of_block(x)`` added up over all vectors of ``rows`` (x), exactly, for each width.

    Tasks hand on each sum in parts of 32 bits, which Spark adds up as longs; the driver
    gets a few parts for each dimension or pair of dimensions, however many rows there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                found = of_block(x).astype(object)
                totals[x.shape[1]] = totals[x.shape[1]] + found if x.shape[1] in totals else found
        for width, total in totals.items():
            power = 0
            while total.any():
                i, j = np.nonzero(total)
                values = total[i, j]
                signs = np.array([-1 if v < 0 else 1 for v in values], object)
                digits = (abs(values) & ((1 << _DIGITS) - 1)) * signs
                columns = [np.full(len(i), width), i, j, np.full(len(i), power), digits.astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _PART_SCHEMA, strict=True)], schema=_PART_SCHEMA
                )
                total[i, j] = (abs(values) >> _DIGITS) * signs
                power += 1

    parts = rows.select("x").mapInArrow(run, _PARTS).groupBy("size", "i", "j", "power")
    found = parts.agg(F.sum("digits").alias("digits")).toArrow()  # by dimensions, not by rows
    sums: dict[int, np.ndarray] = {}
    size, i, j, power, digits = (found.column(n).to_numpy() for n in found.column_names)
    for width in np.unique(size):
        here = size == width
        total = sums[int(width)] = np.zeros((max(i[here]) + 1, max(j[here]) + 1), object)
        for p in np.unique(power[here]):
            at = here & (power == p)
            total[i[at], j[at]] += digits[at].astype(object) * (1 << _DIGITS * int(p))
    return sums


class Model(NamedTuple):
    """Whitening of the vectors of one width; sums are exact."""

    n: int
    sums: np.ndarray  # of each dimension
    middle: np.ndarray  # floor of the mean
    variances: np.ndarray  # falling
    components: np.ndarray  # a row each
    trace: float

    @property
    def rest(self) -> np.ndarray:
        """n times what the mean has above ``middle``."""
        return self.sums - self.n * self.middle

    @property
    def usable(self) -> np.ndarray:
        """Which components vary beyond rounding."""
        return self.variances > max(self.trace, 0) * len(self.sums) * np.finfo(float).eps


def covariance(n: int, rest: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Covariances, divisor ``n``, from the sums of squares of centred dimensions and pairs.

    ``squares`` are about ``middle``, ``rest / n`` off the mean: what that adds is known
    exactly. Then n**2 var(a) and n**2 var(a + b) are integers, and
    cov(a, b) = (var(a + b) - var(a) - var(b)) / 2 is rounded once, at the end.
    """
    width = len(rest)
    own = n * np.diag(squares) - rest * rest
    found = np.zeros((width, width))
    for i in range(width):
        pairs = n * squares[i, i:] - (rest[i] + rest[i:]) ** 2
        cross = pairs - own[i] - own[i:]
        cross[0] = 2 * own[i]
        found[i, i:] = found[i:, i] = [value / (2 * n * n) for value in cross]
    return found


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models, by width, of ``distinct`` (x) vectors; it is read twice.

    The first reading gives counts and sums, the second the squares of ``x`` centred on
    the mean's whole part, for every dimension and for the sum of every pair of them.
    """

    def counted(x: np.ndarray) -> np.ndarray:
        small = not x.size or max(abs(int(x.min())), abs(int(x.max()))) < 1 << 40
        sums = (x if small else x.astype(object)).sum(axis=0, keepdims=True).astype(object)
        return np.concatenate([sums, np.array([[len(x)]], object)], axis=1)

    sums = {}
    for width, total in _exact_sums(distinct, counted).items():
        sums[width] = int(total[0, -1]), total[0, :-1]
    middles = {width: total // n for width, (n, total) in sums.items()}
    squares = _exact_sums(distinct, lambda x: _squares(_shifted(x, middles[x.shape[1]])))
    models = {}
    for width, (n, total) in sums.items():
        if width:
            found = np.zeros((width, width), object)
            given = squares.get(width, np.zeros((0, 0), object))
            found[: given.shape[0], : given.shape[1]] = given
            matrix = covariance(n, total - n * middles[width], found)
            values, vectors = np.linalg.eigh(matrix)
            best = vectors.T[::-1][:components]
            # either sign is right; the largest entry is made positive
            most = np.abs(best).argmax(axis=1)
            best = best * np.sign(best[np.arange(len(best)), most])[:, None]
            models[width] = Model(n, total, middles[width], values[::-1][:components], best, float(np.trace(matrix)))
    return models


_PROJECTED = "vec_id long, size int, deviation decimal(38,0), whitened array<double>"


def _projected(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """(vec_id, size, deviation, whitened) of quantised rows (vec_id, x)."""
    types = [pa.int64(), pa.int32(), pa.decimal128(38, 0), pa.list_(pa.float64())]

    def deviations(z: np.ndarray, model: Model) -> list[Decimal | None]:
        n, rest = model.n, model.rest
        long = z.dtype != object and n * _SMALL * z.shape[1] < 1 << 62
        squares = (z * z).sum(axis=1).astype(object)
        cross = (z @ rest.astype(np.int64) if long else z.astype(object) @ rest).astype(object)
        found = n * n * squares - 2 * n * cross + int((rest * rest).sum())
        return [Decimal(v) if v < 10**38 else None for v in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch.column(1)):
                model = models.get(x.shape[1])
                if model is None:  # no entries, no components
                    continue
                z = _shifted(x, model.middle)
                centred = z.astype(float) - (model.rest / model.n).astype(float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    white = centred @ model.components.T / np.sqrt(model.variances)
                white = np.where(model.usable, white, np.nan)
                columns = [
                    batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1])).cast(pa.int32()),
                    pa.array(deviations(z, model), types[2]),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1, dtype=np.int32) * white.shape[1]),
                        pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "deviation", "whitened"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, _PROJECTED)


def _identity_errors(fitted: DataFrame, models: dict[int, Model], components: int) -> dict[int, float | None]:
    """Largest entry of the whitened vectors' covariance minus the identity, by width."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    of = [F.get("whitened", F.lit(i)) for i in range(components)]
    found = fitted.groupBy("size").agg(*[F.covar_pop(of[i], of[j]) for i, j in pairs]).collect()  # a row a width
    errors: dict[int, float | None] = {}
    for row in found:
        usable = models[row[0]].usable
        here = [(i, j, c) for (i, j), c in zip(pairs, row[1:], strict=True) if max(i, j) < len(usable)]
        off = [abs(c - (i == j)) for i, j, c in here if usable[i] and usable[j]]
        errors[row[0]] = float(max(off)) if off else None
    return errors


RESULTS = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def _described(spark: SparkSession, models: dict[int, Model], errors: dict[int, float | None]) -> DataFrame:
    rows = [
        (width, k, model.n, float(value) / model.trace if model.trace > 0 else None, errors.get(width))
        for width, model in models.items()
        for k, value in enumerate(model.variances, 1)
    ]
    return spark.createDataFrame(rows, "size int, component int, n long, explained double, identity_error double")


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Every vector on the first principal components, scaled to variance 1; see RESULTS.

    Entries are quantised (:func:`quantised`). The fit is over each distinct quantised
    vector once, so no group of copies weighs more than one: counts, sums, and squared
    centred values of every dimension and of the sum of every pair of dimensions are
    added up exactly, and differences of those variances are the covariances. Copies are
    told apart by whole vectors, with partial aggregation before the shuffle; the distinct
    vectors are written once and read by the following steps. The driver holds a square
    matrix of the dimensions.

    ``n`` counts the fitted vectors, ``deviation`` is the sum over dimensions of
    (n * x - S)**2 (null beyond 38 digits), ``explained`` the component's share of the
    variance, ``identity_error`` how far the whitened fit's covariance is from the identity.
    A component that doesn't vary has null ``whitened``; without any variance ``explained``
    and ``identity_error`` are null as well. Vectors of different lengths are fitted apart;
    those without entries have no components and no rows. Repeated rows and null ids come
    back as they are; an empty table has no rows. Other columns, however called, play no part.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col)
    distinct = stage(rows.select("x").distinct(), "vectors")
    models = fit(distinct, components)
    fitted = _projected(distinct.select(F.lit(None).alias("vec_id"), "x"), models)
    errors = _identity_errors(fitted, models, components)
    placed = _projected(rows, models).select(
        "vec_id", "size", "deviation", F.posexplode("whitened").alias("position", "whitened")
    )
    placed = placed.withColumn("component", (F.col("position") + 1).cast("int"))
    names = [part.split()[0] for part in RESULTS.split(", ")]
    return placed.join(F.broadcast(_described(spark, models, errors)), ["size", "component"]).select(*names)
