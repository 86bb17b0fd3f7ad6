"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of a link table; the component is its smallest node.

    Each round links every node to the smallest neighbour it knows of, first seen from its larger neighbours,
    then from its smaller ones, until every link leads straight to the smallest node of its component. A round
    only groups by node, combining before the shuffle, and joins; no neighbourhood is gathered. The number of
    rounds grows with the logarithm of the longest chain. Links with a null end are ignored.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        # large star: larger neighbours of u move to the smallest node among u and its neighbours
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours move to the smallest of them
        large = stored(large.where("u <> v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = stored(low.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "links")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
