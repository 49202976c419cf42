import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapeline.llm import packing
from tapeline.llm.queries import PATTERN, VOCABULARY

from conftest_llm import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check(rows, docs, tokenizer):
    """Each token of each document lies in one piece; sequences have no gap and little padding."""
    expected = sorted([(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in docs], key=repr)
    pieces = {}
    for row in rows:
        assert zlib.crc32(row.ids) >= 0 and len(row.ids) == 4 * row.length > 0
        pieces.setdefault(row.sequence_id, []).append(row)
    for parts in pieces.values():
        at = 0
        for row in sorted(parts, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at == 1024 or at < 1024 and at & (at - 1) == 0
    found = {}
    for row in rows:
        found.setdefault(row.doc_id, []).append(row)
    if len(found) == len(expected):  # ids are unique
        for doc_id, ids in expected:
            parts = sorted(found[doc_id], key=lambda r: r.start)
            joined = np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist()
            assert joined == ids and all(r.doc_tokens == len(ids) for r in parts)
            assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1].tolist()]
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = packing.pack(docs, VOCABULARY, PATTERN).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_odd_rows(docs_of, odd_texts, clashing, tokenizer):
    texts = [*odd_texts, "<|endoftext|>", " " * 1_200_000 + "x", "x" + " \n" * 600_000]
    docs = clashing(docs_of(texts))
    check(packing.pack(docs, VOCABULARY, PATTERN).collect(), list(enumerate(texts)), tokenizer)
    repeated = docs_of([(None, "a b"), (1, "c"), (1, "c")])
    check(packing.pack(repeated, VOCABULARY, PATTERN).collect(), [(None, "a b"), (1, "c"), (1, "c")], tokenizer)
    assert packing.pack(docs_of([]), VOCABULARY, PATTERN).count() == 0


def test_first_fit_decreasing_against_a_plain_scan():
    sizes = np.random.default_rng(3).integers(1, 1024, 500).tolist()
    bins, room = [], []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, free in enumerate(room) if free >= sizes[item]), len(bins))
        if at == len(bins):
            bins.append([])
            room.append(1024)
        bins[at].append((item, 0, sizes[item]))
        room[at] -= sizes[item]
    assert packing.first_fit_decreasing(sizes) == bins


def test_gaps_are_filled_without_loss():
    sizes = np.random.default_rng(4).integers(1, 1024, 300).tolist()
    filled = packing.fill_gaps(packing.first_fit_decreasing(sizes))
    totals = [sum(b - a for _, a, b in part) for part in filled]
    assert sum(totals) == sum(sizes) and sum(t < 1024 for t in totals) <= 10
    covered = sorted(p for part in filled for p in part)
    for item, size in enumerate(sizes):
        parts = [(a, b) for i, a, b in covered if i == item]
        assert parts[0][0] == 0 and parts[-1][1] == size
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def test_added_tokens_have_their_own_ids(spark, docs_of):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"a{end}b", f"a {end} b \n", f"{end}{end}  x", f"<|{end}|>", "<|endoftext", f"é{end}" * 700, None]
    texts.append(" " * 200_000 + f"x{end}y" + "\n" * 200_000)
    docs = docs_of(texts)
    rows = packing.pack(docs, VOCABULARY, PATTERN, added_tokens=True).collect()
    check(rows, list(enumerate(texts)), library)


def test_queries_give_added_tokens_their_own_ids(spark, docs_of, tmp_path):
    import corpus_pipeline
    from tapeline.llm.queries import op1_packing

    docs = docs_of(["a<|endoftext|>b"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = np.array([64, 50256, 65, 0], "<u4").tobytes()
    [row] = op1_packing(spark, str(tmp_path)).collect()
    assert (row.length, row.doc_tokens, row.ids_crc32) == (4, 4, zlib.crc32(ids))
    assert corpus_pipeline.packed(spark, docs, str(tmp_path)).first().ids == ids
