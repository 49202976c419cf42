import io
import itertools
from zlib import crc32

import numpy as np
import pytest
import regex
from tokenizers import Tokenizer

from tapeline.llm import token_files
from tapeline.llm.packing import encoder_with_added
from tapeline.llm.queries import PATTERN, QUERIES, SCAN_PATTERN, VOCABULARY
from tapeline.llm.token_files import FileError, Writer, pack_ranks, read_file, unpack_ranks

from conftest_llm import SF_DIR


def expected(texts):
    """(start, n_tokens, ids) in the given order, by the library itself."""
    tokenizer, rows, start = Tokenizer.from_file(VOCABULARY), [], 0
    for text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        rows.append((start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return rows


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 5, 1000])
def test_numbers_come_back(count):
    random = np.random.default_rng(count)
    numbers = (random.integers(0, 1 << 32, count, np.uint64) >> random.integers(0, 32, count, np.uint64)).astype("<u4")
    edges = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], "<u4")
    for values in (numbers, np.concatenate([numbers, edges])):
        control, data = pack_ranks(values)
        assert len(control) == -(-len(values) // 4)
        assert len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in values)
        assert (unpack_ranks(control, data, len(values)) == values).all()


def test_control_bytes_against_a_plain_reading():
    control, data = pack_ranks(np.array([1, 300, 70_000, 1 << 30, 9], "<u4"))
    assert control == bytes([0b11_10_01_00, 0])
    assert data == b"\x01" + (300).to_bytes(2, "little") + (70_000).to_bytes(3, "little") + (1 << 30).to_bytes(4, "little") + b"\x09"


def test_the_faster_pattern_cuts_as_the_given_one(odd_texts):
    given, faster = regex.compile(PATTERN), regex.compile(SCAN_PATTERN)
    for parts in itertools.product([" ", "\n", "'", "s", "ll", "ve", "é", "1", "²", "!", "字", "\u00a0", "\u2028"], repeat=4):
        assert given.findall("".join(parts)) == faster.findall("".join(parts))
    for code in [*range(0xD800), *range(0xE000, 0x30000)]:
        text = f"a{chr(code)} {chr(code)}'s'{chr(code)}1"
        assert given.findall(text) == faster.findall(text)
    vocabulary = open(VOCABULARY, "rb").read()
    encode, faster_encode = (encoder_with_added(vocabulary, p) for p in (PATTERN, SCAN_PATTERN))
    for text in [*odd_texts, "it's  we'll\t\tthey've 12 1a \n\n x \n"]:
        assert encode(text or "") == faster_encode(text or "")


def written(docs, by_rank=np.arange(100), start=7):
    out = io.BytesIO()
    writer = Writer(out, start, by_rank)
    for doc_id, ranks in docs:
        writer.begin(doc_id, len(ranks))
        writer.add(ranks)
    writer.finish()
    return out.getvalue()


def test_documents_across_blocks(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 10)
    random = np.random.default_rng(1)
    docs = [(i if i % 5 else None, random.integers(0, 100, n)) for i, n in enumerate([1, 9, 10, 11, 35, 3, 1, 1, 20, 2])]
    by_rank = random.permutation(100)
    found, start = {}, 7
    for doc, ids in read_file(io.BytesIO(written(docs, by_rank))):
        found.setdefault(doc, []).extend(ids.tolist())
    for (doc_id, ranks), (doc, ids) in zip(docs, found.items(), strict=True):
        assert doc == (doc_id, start, len(ranks)) and ids == by_rank[ranks].tolist()
        start += len(ranks)
    assert list(read_file(io.BytesIO(written([])))) == []
    with pytest.raises(ValueError, match="at least"):
        written([(1, np.array([], int))])


def test_damaged_files():
    data = written([(1, np.arange(60)), (2, np.arange(30))])
    for cut in (3, 15, 100, 450, len(data) - 1):
        with pytest.raises(FileError):
            list(read_file(io.BytesIO(data[:cut])))
    for at in (0, len(data) - 50, len(data) - 3):
        with pytest.raises(FileError):
            list(read_file(io.BytesIO(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])))
    with pytest.raises(FileError):
        list(read_file(io.BytesIO(data + b"x")))


def test_whole_table(spark):
    rows = QUERIES["op13_token_files"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    want = [(d.doc_id, s, n, crc32(ids)) for d, (s, n, ids) in zip(docs, expected([d.text for d in docs]), strict=True)]
    assert sorted(tuple(r) for r in rows) == want


@pytest.mark.parametrize("file_tokens", [1, 500, 1 << 24])
def test_odd_texts_in_several_files(spark, docs_of, clashing, odd_texts, tmp_path, file_tokens, monkeypatch):
    monkeypatch.setattr(token_files, "PIECE_TOKENS", 4096)
    texts = [*odd_texts, "a<|endoftext|>b", "<|endoftext|>", "word " * 30_000]
    docs = clashing(docs_of(texts).repartition(3))
    files = token_files.write_token_files(docs, str(tmp_path / "files"), VOCABULARY, PATTERN, file_tokens=file_tokens)
    rows = sorted(token_files.read_token_files(files, with_ids=True).collect())
    want = [(i, s, n, crc32(ids), ids) for i, (s, n, ids) in enumerate(expected(texts))]
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in rows] == want
    listed = sorted(files.collect(), key=lambda r: r.start)
    assert len(listed) == {1: len(texts), 500: len(texts), 1 << 24: 1}[file_tokens]
    assert listed[0].start == 0 and all(a.start + a.tokens == b.start for a, b in zip(listed, listed[1:], strict=False))
    assert sum(f.docs for f in listed) == len(texts)


def test_frequent_ids_take_a_byte(spark, docs_of, tmp_path):
    docs = docs_of(["the cat sat on the mat. " * 400] * 5)
    (file,) = token_files.write_token_files(docs, str(tmp_path / "files"), VOCABULARY, PATTERN).collect()
    (path,) = (tmp_path / "files").iterdir()
    assert path.stat().st_size < 1.3 * file.tokens  # a byte and two bits each


def test_null_and_repeated_ids_and_empty_tables(spark, docs_of, tmp_path):
    docs = [(2, "b"), (None, "z"), (1, "a b c"), (2, None), (None, None), (2, "b")]
    files = token_files.write_token_files(docs_of(docs), str(tmp_path / "files"), VOCABULARY, PATTERN)
    rows = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    ordered = [(1, "a b c"), (2, None), (2, "b"), (2, "b"), (None, None), (None, "z")]
    want = [(d, s, n, crc32(ids)) for (d, _), (s, n, ids) in zip(ordered, expected([t for _, t in ordered]), strict=True)]
    assert [tuple(r) for r in rows] == want
    none = token_files.write_token_files(docs_of([]), str(tmp_path / "none"), VOCABULARY, PATTERN)
    assert none.count() == 0 and token_files.read_token_files(none).count() == 0


def test_a_file_that_is_not_the_listed_one(spark, docs_of, tmp_path):
    files = token_files.write_token_files(docs_of(["a b", "c"]), str(tmp_path / "files"), VOCABULARY, PATTERN)
    more = files.selectExpr("path", "start", "tokens + 1 as tokens", "docs")
    with pytest.raises(Exception, match="isn't the listed one"):
        token_files.read_token_files(more).collect()
