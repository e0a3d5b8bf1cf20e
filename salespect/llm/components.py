"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import release, staged


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    out = staged(edges, "links")
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return out, tuple(out.agg(F.count("*"), digest).first())


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b), undirected: for every node in a link, (node, component), the component being its smallest node.

    Each round hangs every node on the smallest of its neighbours; rounds grow
    with the logarithm of the longest path. Sums per node are combined before
    the shuffle, and joins on a busy node can be split at run time. Nulls and
    self links are left out.
    """
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, mark = _written(ends.where("a is not null and b is not null and a <> b").distinct())
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        least = least.select("n", F.least("n", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "links")
        lower = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(lower, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lower.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
        last, before = edges, mark
        edges, mark = _written(small)
        release(last, large)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
