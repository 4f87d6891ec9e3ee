"""Connected components of a link table by contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def roots(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every end of an ``(a long, b long)`` edge; the root is the same in a component.

    Each round points every node to its smallest neighbour (or itself), follows
    the pointers twice, and replaces both ends of all edges by what they point
    to. A component shrinks at least by half a round; edges inside one vanish. The loop
    ends when no edge is left, so its length grows with the logarithm of the
    longest path. Rounds are cut with ``checkpoint``.
    """
    both = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut(both(edges.where("a <> b")).distinct())
    found = None
    while not edges.isEmpty():
        to = cut(edges.groupBy("a").agg(F.min("b").alias("b"))
                 .select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        for _ in range(2):
            ahead = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            to = cut(to.join(ahead, "to").select("node", F.col("next").alias("to")))
        if found is None:
            found = to.select("node", F.col("to").alias("root"))
        else:
            moved = to.select(F.col("node").alias("root"), F.col("to").alias("next"))
            found = cut(found.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        half = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("x", "b")
        full = half.join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = cut(full.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
