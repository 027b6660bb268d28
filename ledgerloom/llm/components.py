"""Connected components of an edge table by contraction.

Each round points every node at the least of itself and its neighbours, follows the pointers to their ends by doubling, and
replaces the edges by edges between the ends. A round at least halves the nodes that still have edges. All steps are joins and
map-side aggregated groupings, so a node with very many edges is no burden to one task, and every table is written to the
shared folder before it is used again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _ends(edges: DataFrame) -> DataFrame:
    """(a, p): for each node the end of its pointer chain."""
    pointers = stored(edges.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "pointers")
    while True:
        nxt = pointers.select(F.col("a").alias("_n"), F.col("p").alias("_q"))
        jumped = stored(pointers.select("a", "p").join(nxt, F.col("p") == F.col("_n")).select("a", F.col("_q").alias("p"), (F.col("_q") != F.col("p")).alias("moved")), "jumped")
        discard(pointers)
        if jumped.where("moved").isEmpty():
            return jumped
        pointers = jumped


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the least node that can be reached."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    left = stored(both, "edges")
    result = None
    while not left.isEmpty():
        ends = _ends(left).select("a", "p")
        end = ends.select(F.col("a").alias("_n"), F.col("p").alias("_e"))
        result = ends.withColumnRenamed("a", "node").withColumnRenamed("p", "component") if result is None else stored(
            result.join(end, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_e", "component").alias("component")), "labels")
        other = ends.select(F.col("a").alias("_m"), F.col("p").alias("_f"))
        before, moved = left, left.join(end, F.col("a") == F.col("_n")).join(other, F.col("b") == F.col("_m")).select(F.col("_e").alias("a"), F.col("_f").alias("b"))
        left = stored(moved.where("a <> b").distinct(), "edges")
        discard(before)
    if result is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return result
