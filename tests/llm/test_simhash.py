import random

import pytest
import xxhash

from tapeline.llm import simhash
from tapeline.llm.graph import connected_components

from conftest_llm import SF_DIR


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """The smallest id that each (id, fingerprint) reaches."""
    root = {fp: fp for _, fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = list(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            least[find(fp)] = min(doc_id, least.get(find(fp), doc_id))
    return [(doc_id, fp, least.get(find(fp))) for doc_id, fp in prints]


def check(docs):
    wanted = components([(r.doc_id, fingerprint(r.text)) for r in docs.collect()])
    found = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_odd_rows(docs_of, odd_texts, clashing):
    check(clashing(docs_of([*odd_texts, "One", "ONE", "a b", "A  b\n"])))
    check(docs_of([(None, "x y z"), (None, "q"), (3, "x y z"), (3, "x y z"), (2, "")]))
    assert simhash.simhash_groups(docs_of([])).count() == 0


def prints_of(spark, values):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    return spark.createDataFrame(signed, "fp long")


@pytest.mark.parametrize("limit", [2, 16, 1000])
def test_links_connect_what_is_near(spark, limit):
    chance = random.Random(limit)
    values = set()
    for _ in range(12):
        centre = chance.getrandbits(64)
        values |= {centre} | {centre ^ (1 << chance.randrange(64)) ^ (1 << chance.randrange(64)) for _ in range(25)}
    values |= {0, (1 << 64) - 1, 1, 3, 7, 1 << 63, (1 << 63) | 1}
    links = simhash.near_links(prints_of(spark, values), 2, limit).collect()
    assert all((r.a % (1 << 64) ^ r.b % (1 << 64)).bit_count() <= 2 for r in links)
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {r.node % (1 << 64): r.root for r in rows}
    near = components([(v, v) for v in sorted(values)])
    groups = {}
    for _, fp, least in near:
        groups.setdefault(least, set()).add(root.get(fp, fp))
    assert all(len(found) == 1 for found in groups.values())


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102), (7, 7), (None, 4)]
    found = connected_components(spark.createDataFrame(chain, "a long, b long"))
    assert dict(found.collect()) == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(docs_of, clashing):
    docs = clashing(docs_of([(4, "a b c d"), (2, "A b c d"), (2, "a b c d"), (None, "a b c d"), (9, "z"), (None, "q r")]))
    rows = simhash.one_per_group(docs)
    assert rows.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in rows.collect()) == [(-1, "q r"), (2, "A b c d"), (9, "z")]
    assert simhash.one_per_group(docs_of([])).count() == 0
