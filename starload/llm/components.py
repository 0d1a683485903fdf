"""Connected components of a table of links, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the component being its least node.

    Alternates two steps until nothing changes: every node links its larger neighbours to the
    least one of all its neighbours, then its smaller ones and itself. Each step takes a
    minimum per node, summed up before its shuffle, and joins it back; a node with many links
    is split by the skewed join. The number of rounds grows with the logarithm of the nodes.
    """
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(links.filter("a <> b").select(big, small).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(
            near.unionByName(least.withColumnRenamed("m", "b")).filter("a <> b").distinct(), "links"
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
