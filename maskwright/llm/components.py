"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links(a, b)``; the root is the smallest node.

    Each round hangs the neighbours of a node on the smallest of them. Minima are
    combined before the shuffle and joined back, so that no neighbourhood is gathered;
    rounds grow with the logarithm of the longest path. An empty table has no nodes.
    """
    u, v = F.col("u"), F.col("v")
    # An edge points from the larger to the smaller node.
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(u != v).distinct(), "edges"
    )
    before = None
    while before != (state := _state(edges)):
        before = state
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v"))
        large = large.where(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(u, v, "m")
        small = small.select(F.explode(F.array(F.struct(u.alias("u"), F.col("m").alias("v")), F.struct(v.alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").where(u != v).distinct(), "edges")
    roots = edges.select(v.alias("node"), v.alias("root")).distinct()
    return edges.select(u.alias("node"), v.alias("root")).unionByName(roots)
