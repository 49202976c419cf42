import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeline.llm import whitening
from tapeline.llm.queries import QUERIES

from conftest_llm import SF_DIR

SCHEMA = "vec_id long, embedding array<float>"


def vectors_of(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")


def quantised(vector):
    return [math.floor(256 * c) for c in vector]


def exact_covariance(distinct):
    """Covariances as fractions, centred before multiplying."""
    n, width = len(distinct), len(distinct[0])
    means = [Fraction(sum(x[i] for x in distinct), n) for i in range(width)]
    centred = [[x[i] - means[i] for i in range(width)] for x in distinct]
    return [[sum(c[i] * c[j] for c in centred) / n for j in range(width)] for i in range(width)]


def test_whole_table(spark):
    rows = QUERIES["op11_whitening"](spark, SF_DIR).toPandas()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    usable = {
        r.vec_id: quantised(r.embedding)
        for r in table.itertuples()
        if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)
    }
    distinct = sorted(set(map(tuple, usable.values())))
    n, sums = len(distinct), np.array(distinct).sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(np.array(distinct, float).T, bias=True))
    assert sorted(zip(rows.vec_id, rows.component, strict=True)) == [(i, k) for i in sorted(usable) for k in range(1, 5)]
    assert set(rows.n) == {n}
    for row in rows.itertuples():
        x = usable[row.vec_id]
        assert row.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums.tolist(), strict=True))
        assert row.explained == pytest.approx(values[-row.component] / values.sum(), rel=1e-9)
    for k in range(1, 5):
        found = rows[rows.component == k].set_index("vec_id").whitened
        x = np.array([usable[i] for i in found.index])
        white = (x - sums / n) @ vectors[:, -k] / math.sqrt(values[-k])
        assert min(abs(found - white).max(), abs(found + white).max()) < 1e-9
    assert set(rows.identity_error) == {rows.identity_error[0]} and rows.identity_error[0] < 1e-9


def test_rows_that_take_no_part_and_copies(spark):
    good = [[0.1, 2.0, -3.5], [0.1, 2.0, -3.5], [-0.0, 1.0, 7.25], [4.0, -1.0, 0.003], [0.5, 0.5, 0.5]]
    odd = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], []]
    rows = whitening.whitened(vectors_of(spark, [*good, *odd])).collect()
    assert sorted({r.vec_id for r in rows}) == [0, 1, 2, 3, 4]
    assert {r.n for r in rows} == {4} and {r.component for r in rows} == {1, 2, 3}
    distinct = sorted({tuple(quantised(v)) for v in good})
    exact = np.array(exact_covariance(distinct), float)
    values = np.linalg.eigh(exact)[0][::-1]
    for r in rows:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), abs=1e-12)
    first = {r.component: r.whitened for r in rows if r.vec_id == 0}
    assert first == {r.component: r.whitened for r in rows if r.vec_id == 1}


def test_covariances_are_exact_differences_of_variances(spark):
    random = np.random.default_rng(3)
    wide = [[float(c) for c in v] for v in random.normal(size=(60, 5)) * [1, 1e3, 1e-2, 1e12, 1]]
    distinct = [tuple(quantised(v)) for v in wide]
    frame = whitening.quantised(vectors_of(spark, wide)).select("x").distinct()
    model = whitening.fit(frame, 5)[5]
    exact = exact_covariance(distinct)
    middle = model.middle
    squares = sum(
        np.array([[(x[i] - middle[i] + (x[j] - middle[j] if i != j else 0)) ** 2 for j in range(5)] for i in range(5)], object)
        for x in distinct
    )
    found = whitening.covariance(model.n, model.rest, squares)
    assert (found == np.array([[float(c) for c in row] for row in exact])).all()
    assert model.trace == pytest.approx(float(sum(exact[i][i] for i in range(5))))


@pytest.mark.parametrize("scale", [1.0, 2.0**40])
def test_sums_are_exact_at_any_size(spark, scale):
    vectors = [[3 * scale, -scale], [scale, 5 * scale], [scale / 2, 0.0], [7.0, 9.0]]
    rows = {(r.vec_id, r.component): r for r in whitening.whitened(vectors_of(spark, vectors)).collect()}
    x = [quantised(v) for v in vectors]
    sums = [sum(v[i] for v in x) for i in range(2)]
    for i, v in enumerate(x):
        assert rows[i, 1].deviation == sum((4 * c - s) ** 2 for c, s in zip(v, sums, strict=True))
    assert rows[0, 1].identity_error < 1e-6


def test_vectors_without_variance(spark):
    rows = whitening.whitened(vectors_of(spark, [[1.0, 2.0]] * 3)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, None, None, None)] * 6
    line = whitening.whitened(vectors_of(spark, [[1.0, 2.0], [2.0, 2.0], [4.0, 2.0]])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert all(r.identity_error < 1e-9 for r in line)
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    assert whitening.whitened(vectors_of(spark, [None, [], [float("nan")]])).count() == 0


def test_lengths_apart_null_ids_and_other_columns(spark, clashing):
    vectors = [(None, [1.0, 2.0]), (None, [3.0, -2.0]), (7, [0.0, 9.0]), (7, [0.0, 9.0]), (8, [1.0]), (9, [2.0])]
    rows = clashing(spark.createDataFrame(vectors, SCHEMA)).withColumns({c: F.lit("x") for c in ("x", "size", "v", "component")})
    found = whitening.whitened(rows).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in found) == sorted(
        [*[("None", k, 3) for k in (1, 2)] * 2, *[("7", k, 3) for k in (1, 2)] * 2, ("8", 1, 2), ("9", 1, 2)]
    )
    assert sorted(abs(r.whitened) for r in found if r.vec_id in (8, 9)) == [1.0, 1.0]


def test_a_hot_vector_is_reduced_before_the_shuffle(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(2.0)))
        .otherwise(F.array(F.col("id").cast("double"), F.lit(0.5))).alias("embedding"),
    )
    plan = whitening.quantised(rows).select("x").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    found = whitening.whitened(rows)
    assert found.count() == 80_000 and found.select("n").first().n == 13_335
