import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import pytest
import regex
from pyspark.sql import functions as F

from checks.compare import duckdb_tables
from tapeline.llm import resampling
from tapeline.llm.oracle import ORACLE
from tapeline.llm.queries import QUERIES

from conftest_llm import SF_DIR

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def features_of(text, min_n, max_n):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(min_n, max_n + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, min_n=1, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """(n_features, weight, score, rank) by place, for docs (id, text) in order of id."""

    def hashed(text):
        return [crc32(f.encode()) % buckets for f in features_of(text, min_n, max_n)]

    own = [hashed(text) for _, text in docs]
    raw, aim = Counter(b for bs in own for b in bs), Counter(b for text in target for b in hashed(text))
    all_raw, all_aim = raw.total(), aim.total()
    gain = [
        math.floor(1000 * math.log((aim[b] + 1) * (all_raw + buckets) / ((raw[b] + 1) * (all_aim + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for (doc_id, text), bs in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        rows.append((len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = [i for i, (_, text) in enumerate(docs) if len(words_of(text)) >= min_words]
    drawn = sorted(fit, key=lambda i: (-rows[i][2], i))[: percent * len(fit) // 100]
    ranks = {i: k for k, i in enumerate(drawn, 1)}
    return [(*row, ranks.get(i)) for i, row in enumerate(rows)]


def found(rows):
    ordered = sorted(rows.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    return [(r.n_features, r.weight, r.score, r["rank"]) for r in ordered]


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_overlapped_spans_are_all_runs_of_words(n, odd_texts):
    texts = ["A b\tc--d", "a a a a a a a a", "x", " ", "é1 ß字 İ K Z_9", "a" * 5000 + " b c", *odd_texts]
    for text in texts:
        words = resampling.collapsed(text or "")
        grams = [words[a:b].decode() for a, b in resampling.spans(words, n)]
        assert grams == features_of(text, n, n)
        ids = resampling.bucket_ids(words, n, n, 70_000)
        assert ids.tolist() == [crc32(g.encode()) % 70_000 for g in grams]


def test_words_of_every_character():
    text = "".join(f"x{chr(c)}y " for c in [*range(0x300), 0x2028, 0x3000, 0xFFFF, 0x1F600])
    assert resampling.collapsed(text).decode().split(" ") == words_of(text)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = QUERIES["op12_resampling"](spark, SF_DIR)
    assert {t for _, t in rows.dtypes} == {"bigint"}
    assert found(rows) == expected([(r.doc_id, r.text) for r in docs], target)
    answer = duckdb_tables(SF_DIR).execute(ORACLE["op12_resampling"])
    names = [c[0] for c in answer.description]
    assert sorted(map(tuple, answer.fetchall()), key=str) == sorted(map(tuple, rows.select(names).collect()), key=str)


@pytest.mark.parametrize(("min_n", "max_n"), [(1, 2), (2, 3)])
def test_longer_runs(spark, docs_of, clashing, odd_texts, min_n, max_n):
    draw = random.Random(7)
    texts = [*odd_texts, *(" ".join(draw.choice("abcdef") * draw.randint(1, 3) for _ in range(draw.randint(1, 60))) for _ in range(60))]
    target = ["ab aa cc dd " * 9, None, ""]
    options = {"min_n": min_n, "max_n": max_n, "buckets": 97, "percent": 25, "min_words": 5, "seed": 3}
    rows = resampling.importance_ranks(clashing(docs_of(texts)), docs_of(target), **options)
    assert found(rows) == expected(list(enumerate(texts)), target, **options)


def test_null_and_repeated_ids(spark, docs_of):
    text = "one two three four five six"
    docs = [(1, text), (1, text + " z"), (1, text), (2, None), (None, text), (None, "zz " * 30), (3, "")]
    ordered = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] is not None, d[1] or ""))
    rows = resampling.importance_ranks(docs_of(docs), docs_of([text]), min_words=5, percent=60)
    got = sorted((str(r.doc_id), r.n_features, r.weight, r.score, str(r["rank"])) for r in rows.collect())
    want = expected(ordered, [text], min_words=5, percent=60)
    assert got == sorted((str(d[0]), *w[:3], str(w[3])) for d, w in zip(ordered, want, strict=True))
    assert sorted(r["rank"] for r in rows.filter("rank is not null").collect()) == [1, 2, 3]


def test_empty_tables(docs_of):
    docs = docs_of([(5, "alpha beta gamma " * 10)])
    assert resampling.importance_ranks(docs_of([]), docs).count() == 0
    assert found(resampling.importance_ranks(docs, docs_of([]), percent=100)) == expected(
        [(5, "alpha beta gamma " * 10)], [], percent=100
    )


def test_drawn_rows_are_whole(docs_of, clashing):
    texts = [f"{'even' if i % 2 else 'odd'} word {i} " * 8 for i in range(50)]
    docs, target = clashing(docs_of(texts)), docs_of(["even word"] * 20)
    drawn = resampling.resampled(docs, target, percent=20)
    ranks = resampling.importance_ranks(docs, target, percent=20).filter("rank is not null")
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranks.collect())
    assert drawn.count() == 10


def test_ranges_are_numbered_apart(spark):
    rows = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 7).alias("v")).repartition(13)
    placed = resampling._positions(rows.sort(F.desc("v"), "key"))
    got = [(r.v, r.key) for r in placed.orderBy("position").collect()]
    assert got == sorted(((i % 7, i) for i in range(5000)), key=lambda p: (-p[0], p[1]))
    assert placed.agg(F.min("position"), F.max("position")).first()[:] == (1, 5000)
    assert "SinglePartition" not in placed._jdf.queryExecution().toString()
