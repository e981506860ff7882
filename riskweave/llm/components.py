"""Connected components of a graph that is kept distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.sources.workspace import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (``u, v`` long, undirected).

    Contraction: each node points to its neighbour of least hash, if less than
    its own; edges are renamed to these parents and the rest goes on, so the
    graph shrinks by a factor each round. A hub is one row on one side of the
    renaming joins and its edges can be split on the other; the minimum is
    combined before its shuffle. No edges give no rows; loops and repeated edges
    do not matter.
    """
    live = settle(edges.where("u <> v").select("u", "v").distinct())
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        arcs = live.union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        parents = settle(
            arcs.groupBy("u")
            .agg(F.min(rank("v")).alias("least"))
            .select("u", F.least("least", rank("u"))["id"].alias("parent"))
        )
        rounds.append(parents)
        first = parents.withColumnRenamed("parent", "pu")
        second = parents.select(F.col("u").alias("v"), F.col("parent").alias("pv"))
        renamed = live.join(first, "u").join(second, "v").where("pu <> pv")
        live = settle(renamed.select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct())
    if not rounds:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = rounds[0].toDF("node", "root")
    for parents in rounds[1:]:
        step = parents.toDF("root", "parent")
        roots = roots.join(step, "root", "left").select(
            "node", F.coalesce("parent", "root").alias("root")
        )
    return roots
