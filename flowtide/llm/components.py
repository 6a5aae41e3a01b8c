"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of an edge table (a, b): the smallest node it reaches.

    A star step hangs each node on the smallest of its neighbours: sums and joins by node, no list of
    neighbours. Each round is written to the shared folder; rounds grow with the logarithm of the
    largest component. Loops and repeated edges do no harm, nulls are left out, no edge gives no row.
    """
    links = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u is not null and v is not null and u != v").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v"))
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        links = written(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
            .filter("u != v").distinct(), "links")
    nodes = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = links.select(F.col("v").alias("node")).distinct().join(nodes.select("node"), "node", "left_anti")
    return nodes.unionByName(roots.select("node", F.col("node").alias("component")))
