"""Joins and running sums that stay spread out when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_TASK = 500_000


def hot_keys(df: DataFrame, keys: list[str], rows: int = ROWS_PER_TASK) -> DataFrame:
    """Hashes of keys with more rows than a task should get, each with the number of tasks to split it over.

    A key of any share is cut to about ``rows`` rows a task. There are at most (rows of df) / ``rows`` such keys, some 16 bytes
    for every half million rows. Two keys with one hash only cause some needless salting.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias("_key_hash")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows).select("_key_hash", F.ceil(F.col("_n") / F.lit(rows)).cast("int").alias("_fan"))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, spread_by: list[str], hot: DataFrame | None = None) -> DataFrame:
    """Equi join whose hot left keys are split over several tasks.

    ``hot`` is the result of ``hot_keys``; pass it where counting the left side itself would repeat costly work, e.g. when
    a column of the source table already tells. It is broadcast, being bounded (see there): Spark's estimate knows nothing of that bound, and would shuffle
    the whole left side a second time for it.

    ``how`` is one of inner, left, left_semi, left_anti: the kinds where each left row meets the whole
    right group exactly once. Rows of a hot key get a salt from ``spread_by``; only right rows of hot keys are repeated.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"join type {how!r} cannot be salted on the left")
    found = hot_keys(left, keys) if hot is None else hot

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_key_hash", F.xxhash64(*keys)).join(F.broadcast(found), "_key_hash", "left").drop("_key_hash")

    salt = F.pmod(F.xxhash64(F.lit("salt"), *spread_by), F.col("_fan").cast("bigint")).cast("int")
    salted_left = marked(left).withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_fan")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1)
    salted_right = marked(right).withColumn("_salt", F.explode(copies)).drop("_fan")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def spread_nulls(key: Column, spread_by: Column, fan: int = 1024) -> Column:
    """Second join column: 0 for rows with a key, spread values for rows without.

    NULL keys never match, yet hash partitioning would send all of them to one task.
    """
    return F.when(key.isNull(), F.pmod(F.xxhash64(spread_by), F.lit(fan)) + 1).otherwise(F.lit(0).cast("bigint"))


def split_points(df: DataFrame, column: str, buckets: int) -> list[float]:
    """Bounds of about equally full value ranges: a bounded list, from a mergeable quantile sketch."""
    steps = [i / buckets for i in range(1, buckets)]
    found = df.approxQuantile(column, steps, 1.0 / (4 * buckets))
    return [float("-inf"), *(sorted(set(found)) or [0.0]), float("inf")]


def value_ranges(df: DataFrame, column: str, rows: int = ROWS_PER_TASK) -> list[float]:
    """Bounds of value ranges, their number following the rows."""
    return split_points(df, column, max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))


def running_sums(
    df: DataFrame, order: str, sums: dict[str, str], descending: bool, rows: int = ROWS_PER_TASK, cuts: list[float] | None = None
) -> DataFrame:
    """Inclusive running sums over a unique DOUBLE column, with no task that sees all rows.

    Rows go to value ranges of about ``rows`` rows (and as many ranges as there are cores at least); only the sums of whole
    ranges are added up in one place, and the window inside a range has that range's rows. Pass ``cuts`` to reuse ranges.
    """
    cuts = cuts or value_ranges(df, order, rows)
    if len(cuts) < 3:
        raise ValueError("at least one bound between the infinities is needed")
    ranged = Bucketizer(splits=cuts, inputCol=order, outputCol="_range", handleInvalid="keep").transform(df)
    direction = F.col("_range").desc() if descending else F.col("_range").asc()
    before = W.partitionBy(F.lit(0)).orderBy(direction).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(*[F.sum(src).alias(f"_sum_{out}") for out, src in sums.items()])
        .select("_range", *[F.coalesce(F.sum(f"_sum_{o}").over(before), F.lit(0)).alias(f"_before_{o}") for o in sums])
    )
    inner_order = F.col(order).desc() if descending else F.col(order).asc()
    inside = W.partitionBy("_range").orderBy(inner_order).rowsBetween(W.unboundedPreceding, 0)
    # One row per range, at most len(cuts) - 1 of them: the broadcast has a fixed bound.
    joined = ranged.withColumns({f"_in_{o}": F.sum(s).over(inside) for o, s in sums.items()}).join(
        F.broadcast(offsets), "_range"
    )
    return joined.withColumns({o: F.col(f"_before_{o}") + F.col(f"_in_{o}") for o in sums}).select(*df.columns, *sums)
