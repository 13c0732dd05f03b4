"""Connected components by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equifacts.session import stage


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, or the node itself.

    It is written before the join with the edges: both sides then arrive by a shuffle, which
    lets Spark split the edges of a hub.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    return stage(low.select("u", F.least("u", "low").alias("low")), "component-lows")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(u, v)``.

    The root is the component's smallest node. Each round links every node's larger
    neighbours, then its smaller ones, to the smallest node it knows; rounds grow with the
    logarithm of the longest path. Loops and repeated edges change nothing, and a node with
    only loops is no node of the result.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    edges = stage(
        edges.where("u <> v").select(high.alias("u"), low.alias("v")).distinct(), "components")
    before = None
    while (now := _digest(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(
            both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), "low")
            .where("u > low").withColumnRenamed("low", "v").distinct(), "components-large")
        joined = large.join(_lowest(large), "u")
        small = joined.select("v", "low").union(joined.select("u", "low")).toDF("u", "v")
        edges = stage(small.where("u > v").distinct(), "components")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct()).toDF("node", "root")
