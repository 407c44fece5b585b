"""Connected components by repeated contraction, with every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the smallest node it reaches.

    Each round hangs every node under its smallest neighbour and keeps the distinct links between
    what is left. Pointers only go down, so nothing cycles, and at least every second node that has
    a link goes. Rows of a node are combined in the tasks that hold them; lookups by a root that
    many nodes share are joins of two written tables, which adaptive execution splits.
    Null ends and links of a node to itself mean nothing.
    """
    ends = links.select(F.col("a"), F.col("b")).where("a <> b")
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(ends.select(F.explode(both).alias("link")).select("link.*").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        nearest = edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("root")
        )
        rounds.append(written(nearest, "nearest"))
        nearest = rounds[-1]
        moved = edges.join(nearest.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        moved = moved.join(nearest.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        edges = written(
            moved.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    final = rounds.pop()
    while rounds:
        later = final.select(F.col("node").alias("root"), F.col("root").alias("last"))
        final = (
            rounds.pop()
            .join(later, "root", "left")
            .select("node", F.coalesce("last", "root").alias("root"))
        )
        final = written(final, "roots")
    return final
