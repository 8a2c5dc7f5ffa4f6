"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """Rows of (node, root) for every node of the links (a, b); root is one node of the component.

    Each round hooks a node to its neighbour of least hash, if that is less than its own, and contracts the links. The order by
    hash makes chains of any ids shrink by a constant part a round, so rounds grow with the logarithm of the nodes. Rounds are
    written tables; only their link counts reach the driver. Neighbours are never gathered: minima are combined map-side.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    edges = cut_lineage(links.select("a", "b").where("a <> b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), rank("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), rank("a").alias("to")))
        nearest = ends.groupBy("node").agg(F.min("to").alias("to"))
        hooks = cut_lineage(nearest.select("node", F.least(F.col("to"), rank("node"))["id"].alias("up")), "hooks")
        rounds.append(hooks)
        up = lambda c, as_: hooks.select(F.col("node").alias(c), F.col("up").alias(as_))  # noqa: B023, E731
        moved = edges.join(up("a", "x"), "a").join(up("b", "y"), "b").where("x <> y")
        edges = cut_lineage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1].withColumnRenamed("up", "root")
    for hooks in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("up"), "root")
        found = hooks.join(later, "up", "left").select("node", F.coalesce("root", "up").alias("root"))
    return found
