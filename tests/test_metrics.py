import random

import pytest

from postsieve.operators import features, metrics as mx
from postsieve.operators.skew import running_sums

GOLD = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)]


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(GOLD, "y int, p double")


def test_golden(spark, gold):
    assert mx.average_precision(gold, "y", "p").first()[0] == pytest.approx(0.8333333333)
    assert mx.roc_auc(gold, "y", "p").first()[0] == 0.75
    best = mx.best_f1_threshold(gold, "y", "p").first()
    assert (best["threshold"], best["threshold_compat"], best["recall"]) == (0.7, 0.1, 1.0)
    assert best["f1"] == pytest.approx(0.8, abs=1e-8) and best["precision"] == pytest.approx(2 / 3)
    assert mx.suspects(gold, "p").count() == 3 and mx.borderline(gold, "p").count() == 0
    edges = spark.createDataFrame([(0.35,), (0.65,), (0.66,)], "p double")
    assert mx.borderline(edges, "p").count() == 2
    three = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "p double")
    assert mx.exact_quantile(three, "p", 0.9).first()[0] == pytest.approx(3.6)


def test_lowest_threshold_has_no_lower_one(spark):
    df = spark.createDataFrame([(1, 0.4), (1, 0.4)], "y int, p double")
    assert mx.best_f1_threshold(df, "y", "p").first()["threshold_compat"] == 0.0


def test_confusion_without_base(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    m = mx.confusion_metrics(df, "y", "p", 0.5).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_random_scores_brute_force(spark):
    rng = random.Random(11)
    data = [(int(rng.random() < 0.3), rng.choice([0.5, rng.random(), rng.random() * 1e-6])) for _ in range(600)]
    df = spark.createDataFrame(data, "y int, p double")
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert mx.roc_auc(df, "y", "p").first()[0] == pytest.approx(auc)
    ap = sum(
        sum(1 for q in pos if q == s) / len(pos) * sum(1 for q in pos if q >= s) / sum(1 for _, q in data if q >= s)
        for s in sorted({p for _, p in data})
    )
    assert mx.average_precision(df, "y", "p").first()[0] == pytest.approx(ap)
    ordered = sorted(p for _, p in data)
    h = (len(ordered) - 1) * 0.9
    want = ordered[int(h)] + (ordered[int(h) + 1] - ordered[int(h)]) * (h - int(h))
    assert mx.exact_quantile(df, "p", 0.9).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("cuts", [None, [float("-inf"), 10.0, 20.0, float("inf")], [float("-inf"), 99.0, float("inf")]])
def test_running_sums(spark, cuts):
    df = spark.range(50).selectExpr("cast(id as double) x", "id % 7 as n")
    total = 0
    for r in running_sums(df, "x", {"s": "n"}, descending=False, cuts=cuts).orderBy("x").collect():
        total += r["n"]
        assert r["s"] == total


def test_guard_folds_and_weights(spark):
    df = spark.range(103).selectExpr("id", "cast(id % 4 = 0 as int) as y")
    assert features.class_guard(df, "y").first().asDict() == {"classes": 2, "minority": 26, "total": 103, "folds": 5, "ok": True}
    assert features.class_guard(df.where("y = 1"), "y").first()["ok"] is False
    sizes = features.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    weights = {r["y"]: r["weight"] for r in features.class_weights(df, "y").collect()}
    assert weights[1] == pytest.approx(103 / 52)
