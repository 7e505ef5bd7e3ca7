"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest one around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    rest = edges.join(low, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return rest.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component.

    `edges` has columns u and v of one type; loops, repeated and reversed edges
    are allowed, null ends are ignored. Alternates large-star and small-star
    steps until the edges stop changing: they then join each node to its root.
    The graph halves in depth with each round, so rounds grow with the logarithm
    of the longest chain. Each round is a written table, so lineage stays short.
    An empty table gives an empty result.
    """
    now = materialize(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if mark[0] == 0 or mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        now = materialize(_small_star(_large_star(now)), "stars")
