import random

import numpy as np
import pytest

from tapeline.llm import substrings

from conftest_llm import SF_DIR


def brute(docs, window):
    """(words, removed places) by document, in the order given."""
    seen, out = set(), []
    for text in docs:
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - window + 1):
            content = tuple(words[at : at + window])
            if content in seen:
                gone.update(range(at, at + window))
            seen.add(content)
        out.append((len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


def check(docs, texts, window, **options):
    rows = sorted(substrings.without_repeats(docs, window, **options).collect(), key=lambda r: r.doc_id)
    found = [(r.n_words, r.n_removed, " ".join((r.text or "").encode().split() and (r.text or "").split() or [])) for r in rows]
    wanted = brute(texts, window)
    assert [f[:2] for f in found] == [w[:2] for w in wanted]
    if not options:
        assert [r.text or "" for r in rows] == [w[2] for w in wanted]


def passages(seed, n=80, vocabulary=30):
    chance = random.Random(seed)
    stock = [[f"w{chance.randrange(vocabulary)}" for _ in range(chance.randint(5, 90))] for _ in range(12)]
    return [
        " ".join(w for _ in range(chance.randint(0, 5)) for w in chance.choice([chance.choice(stock), [f"u{chance.random()}"] * 3]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("window", [20, 7])
def test_against_brute_force(docs_of, window):
    texts = passages(window)
    check(docs_of(texts), texts, window)


def test_crowded_anchors_and_small_shards(docs_of, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    monkeypatch.setattr(substrings, "BLOCK_SEGMENTS", 10)
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 400)
    texts = passages(1, 120) + ["a " * 300, "b a " * 200, "a " * 50]
    for crowd in (0, 60):
        monkeypatch.setattr(substrings, "CROWD_WORDS", crowd)
        check(docs_of(texts), texts, 20)


def test_a_crowded_anchor_is_spread(docs_of, monkeypatch):
    # windows around one common run differ in every document: one anchor, many segments
    shared = " ".join(f"w{i}" for i in range(12))
    texts = [" ".join([*(f"l{n}-{i}" for i in range(10)), shared, *(f"r{n % 40}-{i}" for i in range(10))]) for n in range(90)]
    monkeypatch.setattr(substrings, "COMMON_SHARE", 1)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 400)
    monkeypatch.setattr(substrings, "CROWD_WORDS", 100)
    keyed = docs_of(texts)
    ranked = substrings._ranked(substrings._occurrences(keyed, "doc_id", "text", np.empty(0, np.uint64), 20))
    wanted = substrings._differing(ranked, 20)
    crowded = wanted.filter("crowded")
    assert crowded.count() > crowded.select("anchor").distinct().count()
    check(keyed, texts, 20)


def test_no_task_ranks_all_segments_of_an_anchor(docs_of):
    occurrences = substrings._occurrences(docs_of(["a b"]), "doc_id", "text", np.empty(0, np.uint64), 20)
    plan = substrings._ranked(occurrences)._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("content" in line and "check" in line for line in windows)


def test_windows_of_a_block_go_with_their_words():
    words = substrings.word_hashes(" ".join(f"w{i}" for i in range(25)))
    crowd = [(5, 3, words), (4, 0, words[:21]), (9, 7, words[4:])]
    (batch,) = substrings._windows(crowd, 10, 7, 20)
    rows = batch.to_pylist()
    assert len(rows) == 6 + 2 + 2 and all(10 <= row["shard"] < 17 for row in rows)
    told = {(row["key"], row["start"]) for row in rows if row["words"] is None}
    assert told == {(5, 3), (5, 4), (9, 7), (9, 8)}
    shards = {}
    for row in rows:
        if row["words"]:
            shards.setdefault(row["words"], set()).add(row["shard"])
    assert all(len(where) == 1 for where in shards.values()) and len(shards) == 6


def test_odd_rows(docs_of, odd_texts, clashing):
    check(clashing(docs_of(odd_texts)).drop("n_words"), odd_texts, 20)
    prose = " ".join(f"w{i}" for i in range(30))
    rows = substrings.without_repeats(docs_of([(1, prose), (1, prose), (None, prose), (0, None)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [(False, 0, 0), (False, 1, 0), (False, 1, 30), (True, 0, 30)]
    assert [r.text for r in rows if r.doc_id == 0] == [None]
    assert substrings.without_repeats(docs_of([])).count() == 0


def test_layout_is_kept(docs_of):
    prose = " ".join(f"w{i}" for i in range(25))
    rows = substrings.without_repeats(docs_of([prose, f"One.\n\n{prose}\n  two\tthree "]), keep_layout=True).collect()
    assert {r.doc_id: r.text for r in rows} == {0: prose, 1: "One.\n  two\tthree "}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    check(docs, [r.text for r in docs.orderBy("doc_id").collect()], 20)


def test_index_counts_as_a_scan_does():
    chance = np.random.default_rng(4)
    parts = [chance.integers(1, 5, n) for n in (40, 25, 30)]
    index = substrings.FMIndex(np.concatenate(parts), np.array([len(p) for p in parts]))
    for size in (1, 2, 3, 5):
        pattern = parts[0][3 : 3 + size]
        low, high = np.zeros(1, np.int64), np.full(1, index.n)
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        places = sum((p[i : i + size] == pattern).all() for p in parts for i in range(len(p) - size + 1))
        assert (high - low)[0] == places


def test_common_grams_are_those_of_all_whole_texts(docs_of, monkeypatch):
    prose = " ".join(f"w{i}" for i in range(10))
    texts = [" ".join(f"u{n}-{i}" for i in range(9_000)) + f" {prose}" for n in range(24)]
    texts += [None, "", "few words"]
    wanted = np.unique(substrings.gram_hashes(substrings.word_hashes(prose), substrings.GRAM))
    keyed = docs_of(texts).coalesce(1)
    assert substrings._common_grams(keyed, "text").tolist() == wanted.tolist()
    monkeypatch.setattr(substrings, "COMMON_SHARE", 1)
    assert len(substrings._common_grams(keyed, "text")) == 0
    assert len(substrings._common_grams(docs_of([]), "text")) == 0


def test_equal_windows_have_equal_anchors():
    words = substrings.word_hashes(" ".join(f"w{i % 40}" for i in range(100)))
    anchor, content, check, start, count = substrings.segments(words, np.empty(0, np.uint64))
    assert count.sum() == 81 and (np.diff(start) == count[:-1]).all()
    runs = set(zip(anchor.tolist(), content.tolist(), check.tolist()))
    assert len(runs) < len(anchor) and len(runs) == len({c for _, c, _ in runs}) == len({c for _, _, c in runs})
