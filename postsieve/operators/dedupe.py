"""Deduplication by key, and related key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions.text import is_blank
from postsieve.operators.skew import skew_join

SEQ = "ingest_seq"


def _first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    # The hash in front lets sorts compare a number before long texts. A rank filter of 1 makes Spark keep
    # one row per key and map task before the shuffle, so copies of a hot key never travel.
    window = W.partitionBy(F.xxhash64(*keys), *keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe_keep_last(df: DataFrame, keys: list[str], seq: str = SEQ) -> DataFrame:
    """Latest row per key; NULL keys count as equal."""
    return _first_per_key(df, keys, F.col(seq).desc())


def dedupe_keep_first(df: DataFrame, keys: list[str], seq: str = SEQ) -> DataFrame:
    """Earliest row per key."""
    return _first_per_key(df, keys, F.col(seq).asc())


def dedupe_posts(df: DataFrame, seq: str = SEQ) -> DataFrame:
    """Latest row per post id; rows without an id by (content, date)."""
    missing = is_blank(F.col("post_id"))
    keyed = df.withColumns(
        {
            "_id": F.when(~missing, F.col("post_id")),
            "_content": F.when(missing, F.col("content")),
            "_date": F.when(missing, F.col("date")),
        }
    )
    return dedupe_keep_last(keyed, ["_id", "_content", "_date"], seq).drop("_id", "_content", "_date")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).where(F.col(keys[0]).isNotNull()).distinct()


def key_counts(df: DataFrame, field: str, seq: str = SEQ) -> DataFrame:
    """Groups of more than one row: their size and the row that would be kept."""
    return (
        df.groupBy(field)
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(seq).alias("keep_seq"))
        .where("cnt > 1")
    )


def duplicate_rows(df: DataFrame, field: str, seq: str = SEQ) -> DataFrame:
    """Every row of a group but its first, as rows (a list per group would have no size bound)."""
    groups = key_counts(df, field, seq).select(F.xxhash64(field).alias("_kh"), F.col(field).alias("_field"), "keep_seq")
    rows = df.select(F.xxhash64(field).alias("_kh"), field, seq)
    met = skew_join(rows, groups, ["_kh"], "inner", [seq])
    same = F.col(field).eqNullSafe(F.col("_field"))  # hashes may collide, and NULLs form a group
    return met.where(same & (F.col(seq) > F.col("keep_seq"))).select(field, seq, "keep_seq")


def assert_unique_key(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; an empty result means the key is unique."""
    return df.where(~is_blank(F.col(key))).groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
