"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import join_groups, stage


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame) -> DataFrame:
    """Each neighbour of a node, with the least of the node and its
    neighbours; a node of very many neighbours is no single task."""
    least = stage(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n")),
                  "star-least")
    return join_groups(pairs, least, ["u"], "n")


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): the least node that
    links reach. Nodes are longs; repeated links and self-links change nothing.
    The links stay distributed, and each round is a table of its own.
    """
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    edges = stage(links.where("a <> b").select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    before = _sum(edges)
    for _ in range(max_rounds):
        both = stage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges-both")
        large = stage(_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").distinct(), "edges-large")
        near = _star(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "edges")
        now = _sum(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
