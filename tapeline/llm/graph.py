"""Connected components of a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.joins import join_back
from tapeline.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is the smallest node reached.

    Large-star and small-star steps: each node's larger neighbours, then its smaller
    ones, are linked to its smallest neighbour, until nothing changes; the number of
    rounds grows with the logarithm of the longest chain. Each round is written to
    the shared folder, so nothing is recomputed when an executor is lost. Only a
    count and a checksum come to the driver. Null ends and self-links are passed over.
    A node that most links meet, as the root of a large component is, takes several
    tasks: both sides of its joins have a shuffle of their own, which AQE can split.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = links.filter("a <> b").select(larger.alias("u"), smaller.alias("v")).distinct()
    edges = stage(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        edges = stage(_small_star(_large_star(edges)), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_back(both, least, ["u"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = join_back(edges, least, ["u"], "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
