"""URL filters: stated host rules first, mined token rules for the rest."""

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import fresh, stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class HostRule(NamedTuple):
    """A verdict on a host with its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str


#: fixed values of the registered query
HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_rule(host: Column, path: Column, rules: Sequence[HostRule], what) -> Column:
    """``what(rule)`` of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = (host == rule.host) | host.endswith(f".{rule.host}")
        chosen = F.when(fits & path.startswith(rule.path), F.lit(what(rule))).otherwise(chosen)
    return chosen


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host suffixes and labels, path parts, query names.

    Digits count as one ``#``, so that page numbers don't make a token each.
    """
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    scheme = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1)

    def named(kind: str, values: Column) -> Column:
        values = F.transform(values, lambda v: F.regexp_replace(v, "[0-9]+", "#"))
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(kind), v))

    labels = F.split(host, r"\.")
    parts = [
        named("s:", F.array(scheme)),
        named("h:", labels),
        named("d:", F.array(F.concat_ws(".", F.slice(F.reverse(labels), 1, 2)))),
        named("p:", F.split(path, "/")),
        named("q:", F.transform(F.split(query, "&"), lambda v: F.substring_index(v, "=", 1))),
    ]
    return F.array_distinct(F.concat(*parts))


def _alike(keyed: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` (token, pages, hits, mark) as classes of tokens that stand on the same pages.

    (token, pages, hits, members): ``token`` is the least member. Tokens of one ``mark``, a
    hash of their pages, are compared page by page; where it misleads, a token stays alone.
    """
    same = Window.partitionBy("pages", "hits", "mark")
    items = stage(items.withColumn("least", F.min("token").over(same)), "items")
    others = items.filter("token != least").select("token", "least", "pages")
    met = keyed.select("tokens", F.explode("tokens").alias("token")).join(others, "token")
    shared = met.groupBy("token").agg(
        F.count_if(F.array_contains("tokens", F.col("least"))).alias("shared"), F.first("pages").alias("all")
    )
    equal = shared.filter(F.col("shared") == F.col("all")).select("token", F.lit(True).alias("equal"))
    items = items.join(equal, "token", "left")
    items = items.withColumn("least", F.when(F.col("equal"), F.col("least")).otherwise(F.col("token")))
    return items.groupBy(F.col("least").alias("token")).agg(
        F.first("pages").alias("pages"), F.first("hits").alias("hits"), F.sort_array(F.collect_set("token")).alias("members")
    )


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.9) -> DataFrame:
    """(rule, items, alike, anchor, confidence, support) of token sets that tell pages to block.

    ``labelled`` is (tokens, block). A set is a rule if its pages to block reach
    ``min_support`` among all and ``min_confidence`` among its own. Only prunes that lose
    no verdict are made: tokens below the support; tokens on the same labelled pages
    count as one item, the least of them, and ``alike`` has all of them for each item; a
    token that is a rule alone, or is on all labelled pages, joins no other set.
    FP-growth finds the sets of the pages to block, from whole URLs; all labelled pages
    that hold a set are then counted by its rarest item, which is its ``anchor``. Sets from
    which an item can go at no loss of confidence are left out.
    No labels, or none to block, give no rules.
    """
    fields = "items array<string>, alike array<array<string>>, anchor string, confidence double, support double"
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], f"rule long, {fields}")
    keyed = labelled.select(F.array_distinct("tokens").alias("tokens"), F.col("block").cast("int").alias("block"))
    keyed = stage(keyed.withColumn("page", F.monotonically_increasing_id()), "labelled")
    total, blocked = keyed.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0))).first()
    if not blocked:
        return empty
    least = max(1, math.ceil(min_support * total))
    counts = keyed.select(F.explode("tokens").alias("token"), "block", "page").groupBy("token").agg(
        F.count("*").alias("pages"), F.sum("block").alias("hits"), F.bit_xor(F.xxhash64("page")).alias("mark")
    )
    classes = stage(_alike(keyed, counts.filter(F.col("hits") >= least)), "classes")
    told = F.col("hits") / F.col("pages")
    single = classes.filter(told >= min_confidence).select(
        F.array("token").alias("items"), F.array("members").alias("alike"), F.col("token").alias("anchor"),
        told.alias("confidence"), (F.col("hits") / total).alias("support"),
    )
    joining = classes.filter((told < min_confidence) & (F.col("pages") < total)).select("token", "pages", "members")
    several = _sets_of_several(keyed, joining, least, total, min_confidence)
    rules = stage(single if several is None else single.unionByName(several), "rules")
    return rules.select(F.monotonically_increasing_id().alias("rule"), *rules.columns)


def _sets_of_several(
    keyed: DataFrame, items: DataFrame, least: int, total: int, min_confidence: float
) -> DataFrame | None:
    """The rules of two or more ``items``, or None."""
    held = keyed.select("page", "block", F.explode("tokens").alias("token")).join(items.select("token"), "token")
    baskets = held.groupBy("page").agg(F.max("block").alias("block"), F.sort_array(F.collect_list("token")).alias("items"))
    baskets = baskets.filter(F.size("items") > 1).groupBy("items", "block").agg(F.count("*").alias("n"))
    baskets = stage(baskets, "baskets")
    to_block = baskets.filter("block = 1").select("items", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    to_block = to_block.select("items")
    n = to_block.count()
    if n < least:
        return None
    found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n).fit(to_block).freqItemsets
    found = found.filter(F.size("items") > 1).select(F.sort_array("items").alias("items"), F.col("freq").alias("hits"))
    found = stage(found.withColumn("set", F.monotonically_increasing_id()), "sets")
    rare = found.select("set", F.explode("items").alias("token")).join(items, "token").groupBy("set").agg(
        F.min_by("token", F.struct("pages", "token")).alias("anchor"),
        F.sort_array(F.collect_list(F.struct("token", "members"))).alias("alike"),
    )
    found = found.join(rare, "set").select("set", "items", "hits", "anchor", F.col("alike.members").alias("alike"))
    found = stage(found, "anchored")

    good = baskets.filter("block = 0").select("n", F.col("items").alias("tokens"), F.explode("items").alias("anchor"))
    met = good.join(found.select("set", "items", "anchor"), "anchor")
    met = met.filter(F.size(F.array_except("items", "tokens")) == 0)
    missed = met.groupBy("set").agg(F.sum("n").alias("missed"))
    told = F.col("hits") / (F.col("hits") + F.coalesce("missed", F.lit(0)))
    found = found.join(missed, "set", "left").withColumn("confidence", told)
    rules = stage(found.filter(F.col("confidence") >= min_confidence), "several")

    shorter = rules.filter(F.size("items") > 2).select(
        "set", "confidence", F.explode("items").alias("item"), F.col("items").alias("all")
    )
    shorter = shorter.withColumn("items", F.array_remove("all", F.col("item")))
    plain = rules.select("items", F.col("confidence").alias("plain"))
    needless = shorter.join(plain, "items").filter("plain >= confidence").select("set").distinct()
    return rules.join(needless, "set", "left_anti").select(
        "items", "alike", "anchor", "confidence", (F.col("hits") / total).alias("support")
    )


def matches(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``tokens`` arrays of ``pages`` (tokens) that hold all items of some rule.

    An item is held by any of the tokens alike. An inverted index: each rule stands
    under its rarest item, so a URL meets only rules whose rarest item it has.
    """
    urls = pages.select("tokens").distinct()
    at = F.array_position("items", F.col("anchor")).cast("int")
    index = rules.select(F.explode(F.element_at("alike", at)).alias("token"), "alike")
    met = urls.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    full = met.filter(F.forall("alike", lambda same: F.arrays_overlap(same, F.col("tokens"))))
    return full.select("tokens").distinct()


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    host_rules: Sequence[HostRule] = HOST_RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    **mining,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict of every row.

    ``labels`` is (doc_id, quality, toxic); it tells of the pages with these ids, and
    one of quality 0 or toxic 1 is to block. Rows of ``labels`` without a page, without
    id or without a verdict tell nothing. The longest stated rule that fits decides;
    then a mined rule blocks; else the page is allowed. A null URL, or one without
    ``://``, has an empty host and path and no tokens: it is allowed. Repeated rows are
    judged alike; other columns come back, except those named like a result.
    """
    results = ("host", "path", "rule", "verdict")
    tokens = fresh(pages, "_tokens")
    keep = [c for c in pages.columns if c.lower() not in results]
    urls = pages.withColumns(
        {tokens: url_tokens(F.col(url_col)), "host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}
    )
    told = labels.groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("block"),
        F.count(F.coalesce("quality", "toxic")).alias("known"),
    )
    told = told.filter("known > 0").select(F.col("doc_id").alias("_id"), "block")
    seen = urls.select(F.col(id_col).alias("_id"), F.col(tokens).alias("tokens")).join(told, "_id")
    rules = stage(mine_rules(seen, **mining), "url-rules")

    open_urls = urls.filter(host_rule(F.col("host"), F.col("path"), host_rules, lambda r: r.verdict).isNull())
    met = matches(open_urls.select(F.col(tokens).alias("tokens")), rules)
    met = stage(met.select(F.col("tokens").alias(f"{tokens}_met")), "met")
    told = urls.join(met, F.col(tokens) == F.col(f"{tokens}_met"), "left")
    mined = F.when(F.col(f"{tokens}_met").isNotNull(), "block").otherwise("allow")
    rule = host_rule(F.col("host"), F.col("path"), host_rules, lambda r: r.host + r.path)
    verdict = host_rule(F.col("host"), F.col("path"), host_rules, lambda r: r.verdict)
    return told.select(
        *keep, "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict")
    )
