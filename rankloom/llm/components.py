"""Connected components of edge tables, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.plans import scratch


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every end of ``edges(a, b)``; the root is the component's smallest vertex.

    In each round every vertex moves to the smallest of itself and its neighbours, and on to where
    that one moves. Edges follow their ends; those that become loops go, equal ones become one, so
    the edges shrink from round to round until none is left. Every round is a stored table. Null
    ends and loops link nothing.
    """
    left = scratch.materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b AND a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    roots = left.select(F.col("a").alias("v")).union(left.select("b")).distinct().select("v", F.col("v").alias("root"))
    roots = scratch.materialise(roots, "roots")
    while not left.isEmpty():
        ends = left.select(F.col("a").alias("v"), F.col("b").alias("to")).union(left.select("b", "a"))
        moves = scratch.materialise(ends.groupBy("v").agg(F.least(F.min("to"), F.col("v")).alias("to")), "moves")
        further = moves.select(F.col("v").alias("to"), F.col("to").alias("end"))
        moves = scratch.materialise(moves.join(further, "to").select("v", F.col("end").alias("to")), "moves")
        of_root = moves.select(F.col("v").alias("root"), "to")
        roots = scratch.materialise(roots.join(of_root, "root", "left").select("v", F.coalesce("to", "root").alias("root")), "roots")
        of_a, of_b = (moves.select(F.col("v").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b"))
        moved = left.join(of_a, "a").join(of_b, "b").where("a_to <> b_to")
        left = scratch.materialise(moved.select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b")).distinct(), "edges")
    return roots
