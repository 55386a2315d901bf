"""Connected components of a table of links, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.session import written


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per node the lowest of itself and its neighbours; added up in each task first, so a hub is a row per task."""
    return pairs.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("node"), F.least("u", "low").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the lowest node reachable, for the nodes of the links (a, b).

    Alternates two steps until nothing changes: link each node's higher neighbours to its lowest, then its lower ones.
    The number of rounds grows with the logarithm of the longest path. Each round's links are written, which cuts the
    lineage. Rows with a null are left out.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), F.col("u") == F.col("node")).where("v > u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
        small = large.join(_lowest(large), F.col("u") == F.col("node"))
        edges = written(small.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            small.select("u", F.col("low").alias("v"))).where("u != v").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
