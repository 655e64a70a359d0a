"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. a is the larger end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one edge, and is no smaller end."""
    ends = edges.select(F.col("a").alias("node"), F.lit(2).alias("end")).union(edges.select(F.col("b").alias("node"), F.lit(1).alias("end")).distinct())
    return ends.groupBy("node").agg(F.sum("end").alias("ends")).where("ends > 2").isEmpty()


def joined_components(part: DataFrame, links: DataFrame, name: str = "edges") -> DataFrame:
    """Components (node, component) after further links (a, b), whose ends may be nodes of none yet.

    Only the links between components are followed; nodes that keep their component are not touched.
    """
    links = stored(links, f"{name}-further")
    for end in ("a", "b"):
        own = part.select(F.col("node").alias(end), F.col("component").alias("_component"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("_component", end)).drop("_component")
    moved = components(links, name)
    former = part.join(moved.select(F.col("node").alias("component"), F.col("component").alias("_component")), "component", "left")
    former = former.select("node", F.coalesce("_component", "component").alias("component"))
    return stored(former.unionByName(moved.join(part, "node", "left_anti")), f"{name}-joined")


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """node and component (its smallest node), for each node of the undirected edges (a, b).

    Edges from a node to itself count for nothing; repeated edges count once. No edges give no
    rows. Steps only join and aggregate by node; a node of very many edges is split by Spark.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _is_stars(edges):
        edges = stored(_small_star(_large_star(edges)), name)
    # Stars now: each node has one edge, to the least node of its component.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
