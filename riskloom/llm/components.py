"""Connected components of a large, sparse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is a component's smallest node.

    Large-star and small-star in turn: every node passes its larger, then its
    smaller neighbours on to the smallest one it knows. Edges never grow in
    number beyond those given, smallest neighbours combine in the map tasks,
    and the rounds are about the logarithm of the longest chain. Each round
    is written, so lost executors cost one round at most.
    """
    edges = stage(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "large-star")
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(nearest.select("a", F.col("m").alias("b"))).distinct()
        edges = stage(small, "small-star")
        # Done when only stars are left: no node has two roots and no root is below another.
        double = edges.groupBy("a").count().filter("count > 1").limit(1).count()
        if not double and not edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi").limit(1).count():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
