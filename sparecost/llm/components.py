"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch


def components(scratch: Scratch, links: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """(node, label) for every node of `links` (a, b), label being the same within a component, and the tables made.

    Each round every node moves to its smallest neighbour, and the graph is contracted to the nodes moved to, so the
    links left shrink quickly. A hot node sends one row per task to the minimum and is split by adaptive joins.
    """
    edges = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    made = [f"{name}-edges-0"]
    edges = scratch.keep(edges, made[0])
    labels, step = edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), 0
    while not edges.isEmpty():
        step += 1
        moves = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        moves = scratch.keep(moves, f"{name}-moves-{step}")
        labels = scratch.keep(labels.join(moves.withColumnRenamed("a", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")), f"{name}-labels-{step}")
        left = edges.join(moves, "a").select(F.col("to").alias("a"), "b")
        left = left.join(moves.select(F.col("a").alias("b"), "to"), "b").select("a", F.col("to").alias("b"))
        edges = scratch.keep(left.filter("a <> b").distinct(), f"{name}-edges-{step}")
        made += [f"{name}-{kind}-{step}" for kind in ("moves", "labels", "edges")]
    return labels, made
