import itertools
from random import Random

import pytest
from pyspark.sql import functions as F

from tapeline.llm import url_rules

SCHEMA = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=(None, None, None))
    return host, path, best[0] and best[0] + best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y=://z", "http://example.net/en", "http://a.net", "http://net/",
    "x://y://z.net/", "http://example.com/de/1#t", "http://notexample.com/de/", "http://a.org/fr/?q", "http://ÄB.org/fr/\n/x",
    "http://a.net?x/", "http://a.net#/", "http://example.com:80/de/", "http://u@a.net/p", "http://.net/",
]


def test_host_rules_against_brute_force(spark, clashing):
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    for table in (pages, clashing(pages)):
        for row in url_rules.judge_urls(table, labels).collect():
            host, path, rule, verdict = brute(URLS[row.page_id])
            assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict or "allow")


@pytest.fixture(scope="module")
def judged(spark):
    pages = [(i, f"http://h{i % 7}.example.io/{'casino' if i % 5 == 0 else 'news'}/{'win' if i % 2 == 0 else 'day'}/{i}") for i in range(400)]
    labels = [(i, int(not (i % 5 == 0 and i % 2 == 0)), 0) for i in range(0, 300)] + [(None, 0, 1), (5000, 0, 0), (3, None, None)]
    table = spark.createDataFrame([(i, u, "") for i, u in pages], SCHEMA)
    return table, spark.createDataFrame(labels, LABELS)


def test_mined_rules_block_unlabelled_pages(judged):
    table, labels = judged
    for row in url_rules.judge_urls(table, labels).collect():
        assert row.verdict == ("block" if "/casino/win" in row.path else "allow"), row


def test_mined_rules_against_a_count(judged):
    table, labels = judged
    told = table.join(labels.filter("quality is not null"), F.col("page_id") == F.col("doc_id"))
    seen = told.select(url_rules.url_tokens(F.col("url")).alias("tokens"), (F.col("quality") == 0).alias("block"))
    rules = url_rules.mine_rules(seen).collect()
    rows = [(set(r.tokens), r.block) for r in seen.collect()]
    assert any(set(r["items"]) == {"p:casino", "p:win"} for r in rules)
    for rule in rules:
        hits = [block for tokens, block in rows if tokens >= set(rule["items"])]
        assert rule.confidence == pytest.approx(sum(hits) / len(hits)) and rule.confidence >= 0.9
        assert rule.support == pytest.approx(sum(hits) / len(rows)) and rule.anchor in rule["items"]


def test_odd_rows(judged, spark):
    table, labels = judged
    assert url_rules.judge_urls(table.limit(0), labels).count() == 0
    assert url_rules.judge_urls(table.union(table), labels).count() == 800
    long = spark.createDataFrame([(i, "http://a.io/" + "/".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)), "") for i in range(0, 60, 10)], SCHEMA)
    rows = url_rules.judge_urls(table.union(long), labels)
    assert rows.count() == 406


def brute_blocked(rows, urls, min_support, longest):
    """Of ``urls`` those that hold a set of at most ``longest`` tokens that is a rule, by counting each set."""
    counts = {}
    for tokens, block in rows:
        for size in range(1, longest + 1):
            for chosen in itertools.combinations(sorted(tokens), size):
                of = counts.setdefault(chosen, [0, 0])
                of[0] += 1
                of[1] += block
    rules = {c for c, (n, hits) in counts.items() if hits >= max(1, min_support * len(rows)) and hits / n >= 0.9}
    return {u for u in urls if any(c in rules for k in range(1, longest + 1) for c in itertools.combinations(sorted(u), k))}


def mined_blocked(spark, rows, urls, **mining):
    labelled = spark.createDataFrame([(list(t), b) for t, b in rows], "tokens array<string>, block int")
    pages = spark.createDataFrame([(sorted(u),) for u in urls], "tokens array<string>")
    found = url_rules.matches(pages, url_rules.mine_rules(labelled, **mining)).collect()
    return {frozenset(r.tokens) for r in found}


def test_a_token_that_is_average_alone_makes_a_rule(spark):
    # a: 20 of 40, b: 20 of 60, both: 20 of 20; their shares are at most that of all pages
    rows = [("ab", 1)] * 20 + [("ax", 0)] * 20 + [("by", 0)] * 40 + [("z", 1)] * 80
    urls = {frozenset("ab"), frozenset("abq"), frozenset("ax"), frozenset("bx"), frozenset("z")}
    expected = {frozenset("ab"), frozenset("abq"), frozenset("z")}
    assert mined_blocked(spark, rows, urls) == brute_blocked(rows, urls, 0.002, 2) == expected


def test_mined_verdicts_against_counting_every_set(spark):
    random = Random(7)
    for share in (0.2, 0.6):
        rows = []
        for _ in range(300):
            tokens = frozenset(random.sample("abcdefgh", random.randint(1, 5))) | {"s"}
            tokens |= {"x", "y"} if "a" in tokens else set()  # a, x, y are on the same pages
            rows.append((tokens, int({"b", "c"} <= tokens or {"d", "e", "f"} <= tokens or random.random() < share / 4)))
        urls = {frozenset(random.sample("abcdefghxyqs", random.randint(1, 6))) for _ in range(200)}
        found = mined_blocked(spark, rows, urls, min_support=0.02)
        assert 0 < len(found) < len(urls) and found == brute_blocked(rows, urls, 0.02, 6)


def test_long_urls_are_counted_whole(spark):
    # 15 tokens each; the good pages differ from those to block in one only
    common = [f"t{i:02}" for i in range(14)]
    rows = [((*common[:i], *common[i + 1 :], "bad", "end"), 1) for i in range(14)]
    rows += [((*common[:i], *common[i + 1 :], "good", "end"), 0) for i in range(14)]
    rows += [(("bad",), 0)] * 9 + [(("end",), 0)] * 9
    urls = {frozenset({"bad", "t03"}), frozenset({"bad", "end"}), frozenset(common), frozenset({"bad"}), frozenset({"end", "t01"})}
    found = mined_blocked(spark, rows, urls, min_support=0.15)
    assert found == brute_blocked(rows, urls, 0.15, 2) == {frozenset({"bad", "t03"}), frozenset({"bad", "end"})}
