"""Connected components of an edge list, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.sources.scratch import materialize_measured


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and a mark that changes when they do."""
    written, seen = materialize_measured(
        edges,
        "component-edges",
        rows=F.count(F.lit(1)),
        mark=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
    )
    return written, (seen["rows"], seen["mark"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); a component is its least node.

    Each round links the larger neighbours of a node to its least neighbour, then the
    smaller ones, until every component is a star. Rounds grow with the logarithm of a
    component's size. A node's neighbours meet only in a minimum, which is taken before
    the shuffle, and in a join that adaptive execution splits, so the centre of a large
    star is no hot spot. Every round is written to the shared folder.

    Null ends and loops are dropped; repeated edges count once; no edges give no rows.
    """
    edges = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u > v")
        .distinct()
    )
    edges, mark = _checked(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        star = least.select("u", F.col("m").alias("v"))
        edges, now = _checked(small.unionByName(star).distinct())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
