"""Groups of linked rows, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.session import cut_lineage


def _drawn(node: str, turn: int) -> Column:
    """An order of the nodes that is drawn anew each round, so that no numbering of them is a bad one."""
    return F.struct(F.xxhash64(F.lit(turn), node).alias("h"), F.col(node).alias("id"))


def contract(edges: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """One round: where each end of an edge (a, b) goes, and the edges that are left between different goals.

    A node goes to the least of its neighbours and itself in the order of the round. Edges inside a group that has become one node are dropped.
    """
    ends = edges.select(F.col("a").alias("node"), _drawn("b", turn).alias("to")).unionByName(
        edges.select(F.col("b").alias("node"), _drawn("a", turn).alias("to"))
    )
    nearest = ends.groupBy("node").agg(F.min("to").alias("to"))
    moves = cut_lineage(nearest.select("node", F.least("to", _drawn("node", turn))["id"].alias("goal")), "moves")
    to = lambda end, goal: moves.select(F.col("node").alias(end), F.col("goal").alias(goal))
    moved = edges.join(to("a", "x"), "a").join(to("b", "y"), "b").where("x <> y")
    return moves, cut_lineage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")


def least_reachable(edges: DataFrame) -> tuple[DataFrame, int]:
    """Rows (node, least) for every end of the edges (a, b), least being the smallest node it can reach; and the number of rounds.

    A round leaves about half of the nodes that still have edges, so rounds grow with the logarithm of the longest chain, and each is
    smaller than the one before. Rounds are written tables; minima are combined before the shuffle, and no group is gathered.
    """
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        moves, edges = contract(edges, len(rounds))
        rounds.append(moves)
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("least")), 0
    found = rounds[-1]
    for moves in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("goal"), F.col("goal").alias("_end"))
        found = moves.join(later, "goal", "left").select("node", F.coalesce("_end", "goal").alias("goal"))
    found = cut_lineage(found, "groups")
    least = found.groupBy("goal").agg(F.min("node").alias("least"))
    return found.join(least, "goal").select("node", F.least("least", "goal").alias("least")), len(rounds)
