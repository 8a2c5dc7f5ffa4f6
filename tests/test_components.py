import random

from pyspark.sql import functions as F

from postsieve.operators.components import contract, least_reachable


def brute(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {x: top(x) for x in up}


def test_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 7), (5, 6), (6, 5)]
    found, _ = least_reachable(spark.createDataFrame(edges, "a long, b long"))
    want = {x: y for x, y in brute([e for e in edges if e[0] != e[1]]).items()}
    assert {r["node"]: r["least"] for r in found.collect()} == want


def test_a_chain_of_10000_takes_few_rounds(spark):
    chain = spark.range(9_999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found, rounds = least_reachable(chain)
    assert rounds <= 20 and found.count() == 10_000 and found.where("least <> 0").count() == 0


def test_edges_inside_a_group_are_dropped(spark):
    star = spark.range(1, 200).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    moves, left = contract(star, 0)
    assert moves.count() == 200 and left.count() < 199
    assert least_reachable(star.limit(0))[0].count() == 0
