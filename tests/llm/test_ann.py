import numpy as np
from pyspark.sql import functions as F

from tapeline.llm import ann

from conftest_llm import SF_DIR



def asks():
    return F.col("vec_id") % 50 == 0
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    good = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        good[vec_id] = np.array(vector, dtype=np.float64)
    out = []
    for query, vector in good.items():
        if query % every == 0:
            scored = [
                (-float((vector * v).sum() / (np.sqrt((vector * vector).sum()) * np.sqrt((v * v).sum()))), i)
                for i, v in good.items()
                if i != query and len(v) == len(vector)
            ]
            out += [(query, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def compare(found, rows, least=1.0):
    wanted = {(q, r): (i, s) for q, r, i, s in brute(rows)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    assert got.keys() == wanted.keys()
    pairs = {(q, i) for (q, _), (i, _) in wanted.items()}
    hits = sum((q, i) in pairs for (q, _), (i, _) in got.items())
    assert hits >= least * max(1, len(pairs)) or not pairs
    if least == 1:
        assert all(got[k][0] == wanted[k][0] and abs(got[k][1] - wanted[k][1]) < 1e-12 for k in got)


def test_recall_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    compare(ann.nearest(table, asks()), [(r.vec_id, r.embedding) for r in table.collect()], 0.98)


def test_recall_at_ten_times_the_size(spark):
    table = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/embeddings.parquet")
    compare(ann.nearest(table, asks()), [(r.vec_id, r.embedding) for r in table.collect()], 0.98)


def test_no_setting_is_left_behind(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    ann.nearest(spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)], SCHEMA), asks()).collect()
    assert spark.conf.get(name) == before


def test_odd_rows(spark, clashing):
    numbers = np.random.default_rng(1).standard_normal((40, 8)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(numbers)]
    rows += [(100 + i, numbers[0]) for i in range(20)]  # ties, with queries among them
    rows += [(200, None), (201, []), (202, [0.0] * 8), (250, [None] * 8), (204, [float("nan")] * 8)]
    rows += [(205, [float("inf")] * 8), (None, numbers[1]), (300, [1.0, 2.0]), (7, numbers[7])]
    table = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    compare(ann.nearest(table, asks()), rows)
    assert ann.nearest(table.limit(0), asks()).count() == 0


def test_error_bounds_hold():
    vectors = np.random.default_rng(2).standard_normal((2000, 64))
    packed, scalars = ann.codes(vectors)
    found, bound = ann.estimate(packed, scalars, vectors[:50])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    assert (np.abs(found - unit[:50] @ unit.T) <= bound).mean() > 0.97
