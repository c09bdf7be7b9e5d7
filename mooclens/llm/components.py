"""Connected components of a graph given as a table of links.

Alternating large-star / small-star: every round each node points at the smallest
neighbour it has seen, and the number of links never grows, so a group of any size
shrinks to a star in O(log^2) rounds. A node's neighbours are never gathered:
each round takes a minimum per node (combined map-side) and joins it back, and
the rounds' tables are stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) with a > b, once each. Large star: link every larger
    neighbour of a node to the node's minimum. Small star: link every smaller
    neighbour, and the node itself, to the minimum."""
    if large:
        seen = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    else:
        seen = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    least = seen.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    new = seen.join(least, "node")
    if large:
        out = new.filter(F.col("other") > F.col("node")).select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        out = new.select(F.col("other").alias("a"), F.col("least").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.filter("a > b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: comparable
    keys, no nulls); component is the smallest node it can reach."""
    now = stored(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    last = None
    while True:
        now = stored(spark, _star(_star(now, True), False), "links")
        sums = now.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
        if sums == last:
            break
        last = sums
    star = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.union(roots)
