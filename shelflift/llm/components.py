"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelflift.llm.common import pin


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), the root being the component's smallest node.

    Each round is joins and aggregates with map-side combination; its edges are written to the scratch folder. The rounds end when an
    edge set repeats, i.e. all nodes point at their root. Loops and repeated edges do no harm; without edges the result is empty.
    """
    edges = pin(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = pin(small.unionByName(parent.withColumnRenamed("m", "v")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    child = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return child.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
