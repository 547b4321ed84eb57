"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, written


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one: u, v with u > v, distinct."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    return not ends.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).filter("c > 1 or (c = 1 and p = 1)").limit(1).count()


def _least(near: DataFrame) -> DataFrame:
    """u, v with m: the least of u and its neighbours. A hub's rows are looked up by broadcast, so no task gets them all."""
    least = written(near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")), "star", narrow=True)
    return lookup(near, least, "u", "degree").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges u, v of any order. Returns node, component (the least node reachable) for every node that has an edge."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "edges", narrow=True)
    for _ in range(most_rounds):
        if _is_forest_of_stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_least(both).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star", narrow=True)
        small = _least(large)
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")).filter("u <> v")).distinct()
        edges = written(small, "small-star", narrow=True)
    else:
        raise RuntimeError(f"no components after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
