"""Connected components by alternating stars, all in Spark.

Links are turned in rounds into stars around the smallest node of each component: the large star hangs all larger
neighbours of a node on its smallest one, the small star all smaller ones. Each round is written to the shared folder;
the number of rounds grows with the logarithm of a component's length. Minima are aggregated before they are shuffled,
and the joins back are plain equi-joins, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import drop, stage


def _stars(edges: DataFrame) -> bool:
    """Whether each node u has one edge (u, v), to a node v that has none itself."""
    many = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return many.unionByName(chained).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) of longs, in any order and repeated. Gives (u, v): each node but the smallest, v, of its component."""
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(pairs, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        drop(edges, large)
        edges = small
    return edges


def merge_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (u, v), as components() gives them, after further links (a, b). Only components that meet are looked at."""
    of = lambda x: labels.select(F.col("u").alias(x), F.col("v").alias(f"{x}_root"))
    roots = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    met = components(roots.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    moved = labels.join(met.select(F.col("u").alias("v"), F.col("v").alias("root")), "v", "left")
    return stage(moved.select("u", F.coalesce("root", "v").alias("v")).unionByName(met), "labels")
