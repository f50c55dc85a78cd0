"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node it reaches.

    Each round points every node at its least neighbour, halves the paths, and replaces the
    edges by those between different roots. Rounds grow with the logarithm of a chain's length.
    Every round's tables are written to the shared folder, so no plan grows and a lost executor
    costs only the running round. Nothing but the number of edges left reaches the driver.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        up = materialize(up.withColumnRenamed("a", "node"), "parents")
        over = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        up = materialize(up.join(over, "up").select("node", F.col("top").alias("root")), "parents")
        if roots is None:
            roots = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = roots.join(step, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root"))
            roots = materialize(roots, "roots")
        a = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = edges.join(a, "a").join(b, "b").where("ra <> rb")
        left = left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = materialize(left, "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
