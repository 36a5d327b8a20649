"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("n"), F.col("v").alias("m")),
                F.struct(F.col("v").alias("n"), F.col("u").alias("m")),
            )
        ).alias("e")
    ).select("e.n", "e.m")


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Hangs the neighbours of each node below the least of them and the node itself.

    The least neighbour comes from an aggregate, which combines before its shuffle, so a node with
    very many neighbours is not gathered in one task.
    """
    least = pairs.groupBy("n").agg(F.min("m").alias("least"))
    least = least.select(F.col("n").alias("node"), F.least("n", "least").alias("root"))
    hung = pairs.join(least, F.col("n") == F.col("node")).select(
        "n", F.col("m").alias("v"), F.col("root").alias("u")
    )
    if keep == "larger":
        return hung.filter("v > n").select("u", "v").filter("u <> v")
    below = hung.filter("v <= n").select("u", "v")
    own = least.select(F.col("root").alias("u"), F.col("node").alias("v"))
    return below.unionByName(own).filter("u <> v")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    Alternates large-star and small-star steps (the number of rounds grows with the logarithm of
    the longest chain) until the edges no longer change. Each round's edges go to a table in the
    shared folder. Nodes are of any ordered type; edges with NULL or equal ends are ignored.
    """
    edges = edges.select("u", "v").filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = stored(edges.distinct(), "edges")
    signature = None
    for _ in range(rounds):
        large = _star(_both_ways(edges), "larger").distinct()
        small = _star(large.select(F.col("v").alias("n"), F.col("u").alias("m")), "smaller")
        edges = stored(small.distinct(), "edges")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == signature:
            break
        signature = now
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return members.unionByName(roots).distinct()
