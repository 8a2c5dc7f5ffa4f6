import pytest
from pyspark.sql import functions as F

from postsieve.operators import skew


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_give_the_plain_result(spark, how):
    """A third of the left rows share one key, another share is NULL."""
    left = spark.range(900).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 50) end as k")
    right = spark.createDataFrame([("hot", 1), ("k5", 2), ("k8", 3), ("k8", 4), ("none", 5)], "k string, v int")
    hot = skew.hot_keys(left, ["k"], rows=100)
    assert hot.count() == 2
    got = skew.skew_join(left, right, ["k"], how, ["id"], hot=hot)
    want = left.join(right, "k", how)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    spread = skew.skew_join(left, right, ["k"], "inner", ["id"], hot=hot)
    assert spread.where("k = 'hot'").count() == 300


def test_hot_keys_are_split_by_rows_whatever_their_share(spark):
    """One key in a thousand is split like one that holds nearly all rows: to the same number of rows a task."""
    rows = [("most",)] * 900 + [("some",)] * 45 + [(f"k{i}",) for i in range(400)]
    df = spark.createDataFrame(rows, "k string")
    fans = sorted(r["_fan"] for r in skew.hot_keys(df, ["k"], rows=20).collect())
    assert fans == [3, 45]
    assert skew.hot_keys(df, ["k"]).count() == 0


def test_value_ranges_follow_the_rows(spark):
    df = spark.range(4000).select(F.col("id").cast("double").alias("x"))
    assert len(skew.value_ranges(df, "x", 100)) - 1 >= 36


def test_nulls_are_spread(spark):
    df = spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).alias("k"), "id")
    assert df.select(skew.spread_nulls(F.col("k"), F.col("id")).alias("s")).where("s > 0").distinct().count() > 30


def test_join_type_is_checked(spark):
    with pytest.raises(ValueError):
        skew.skew_join(spark.range(1), spark.range(1), ["id"], "full_outer", ["id"])
