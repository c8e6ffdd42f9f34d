"""Connected components of a graph by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace


def connected(nodes: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """node and label for each node of ``nodes`` (node, label): the least label in its component.

    ``links`` has pairs (a, b) of nodes. Stars are built by turns: every node that is larger than its
    smallest neighbour hands its neighbours on to that one, until each component is one star around
    its smallest node. The number of turns grows with the logarithm of a component's size.
    A null label is larger than any other.
    """
    edges = work.keep(_downward(links.where("a <> b")), "edges")
    while not edges.isEmpty():
        large = work.keep(_large_star(edges, work), "edges")
        small = work.keep(_small_star(large, work), "edges")
        if small.count() == edges.count() and small.exceptAll(edges).isEmpty():
            break
        edges = small
    home = edges.select(F.col("a").alias("node"), F.col("b").alias("center"))
    homed = nodes.join(home, "node", "left").withColumn("center", F.coalesce("center", "node"))
    least = work.keep(homed.groupBy("center").agg(F.min("label").alias("least")), "least")
    return homed.join(least, "center").select("node", F.col("least").alias("label"))


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node a to the smaller node b."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame, work: Workspace) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour, itself included."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that the join can split a node with very many neighbours.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    least = work.keep(least, "least")
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame, work: Workspace) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = work.keep(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    others = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()
