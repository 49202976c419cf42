import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tapeline.llm import pii
from tapeline.llm.queries import VOCABULARY

from conftest_llm import SF_DIR
from test_quality import base_failed, counts
from test_simhash import components, fingerprint
from test_substrings import brute


def test_stages_against_brute_force(spark, monkeypatch):
    """The labels are too few at this size to certify a cutoff, so base rules decide."""
    staged = {}
    monkeypatch.setattr(corpus_pipeline, "stage", lambda rows, name: staged.setdefault(name, rows.cache()))
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in source if not base_failed(counts(r.text))}

    def found(number):
        return {r.doc_id: r.text for r in staged[f"pipeline-{number}"].collect()}

    assert found(1) == texts
    groups = components([(i, fingerprint(t)) for i, t in texts.items()])
    texts = {i: texts[i] for i, _, least in groups if i == least}
    assert found(2) == texts
    rest = brute(texts.values(), 20)
    assert [" ".join(x for x in found(3)[i].encode().decode().split()) for i in texts] == [" ".join(r[2].split()) for r in rest]
    texts = {i: pii.mask(t) for i, t in found(3).items()}
    assert found(4) == texts
    assert staged["pipeline-4"].filter(F.length("text") != F.col("n_chars")).count() == 0

    tokenizer = Tokenizer.from_file(VOCABULARY)
    parts = {}
    for row in sorted(packed, key=lambda r: r.start):
        parts.setdefault(row.doc_id, []).extend(np.frombuffer(row.ids, "<u4").tolist())
    assert parts == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}


@pytest.mark.parametrize("number", range(4))
def test_filtering_stages_return_documents(spark, docs_of, odd_texts, clashing, number):
    docs = clashing(docs_of([*odd_texts, (None, "x"), (3, "x")]))
    _, function = corpus_pipeline.STAGES[number]
    rows = function(spark, docs, SF_DIR)
    assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
    assert rows.count() <= docs.count()
    assert function(spark, docs_of([]), SF_DIR).count() == 0


def test_packing_stage_takes_odd_rows(spark, docs_of, odd_texts, clashing):
    docs = clashing(docs_of([*odd_texts, (None, "x"), (3, "x")]))
    _, function = corpus_pipeline.STAGES[-1]
    rows = function(spark, docs, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [*odd_texts, "x", "x"]
    tokens = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    assert sum(r.length for r in rows) == sum(tokens)
    assert sum(r.doc_tokens for r in rows if r.start == 0) == sum(tokens)
    assert function(spark, docs_of([]), SF_DIR).count() == 0
