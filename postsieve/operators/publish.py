"""Keyed merge into target tables and the counts that report a load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions.text import is_blank
from postsieve.operators.dedupe import SEQ, dedupe_keep_last
from postsieve.operators.skew import spread_nulls


def upsert_key(df: DataFrame, key: str = "post_id", fallback: str = "content") -> str:
    return key if key in df.columns else fallback


def has_key(df: DataFrame, key: str):
    return ~is_blank(F.col(key)) if dict(df.dtypes)[key] == "string" else F.col(key).isNotNull()


def hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed: those without maps in them."""
    return [name for name, dtype in df.dtypes if "map<" not in dtype and dtype != "variant"]


def latest_by_key(source: DataFrame, key: str, seq: str = SEQ) -> DataFrame:
    """Rows with a key, the last of each."""
    keyed = source.where(has_key(source, key))
    return dedupe_keep_last(keyed, [key], seq) if seq in source.columns else keyed.dropDuplicates([key])


def merge_upsert(
    target: DataFrame, source: DataFrame, key: str, seq: str = SEQ, mark_new: str | None = None, dealt_by: Callable[[Column, Column], Column] | None = None
) -> DataFrame:
    """Update rows of the target by key and insert new ones.

    Columns the source has replace those of an existing row (NULL included), other columns of that row stay.
    Source rows without a key are skipped; of several with one key the last counts. Both sides are unique
    per key, so no task gets a hot key; target rows without a key (blank ones too) are spread and pass through.
    ``mark_new`` names a column that tells the inserted rows.

    ``dealt_by`` gives a number from the key and a number that is 0 for rows with a key and spread for others. Then both sides are moved once, to
    tasks by that number, rows of one key are merged there, and the result stays so dealt. A source row moves even if a later one of
    its key is in the same file, so keys with very many rows should be cut before.
    """
    if dealt_by is not None:
        return _merge_dealt(target, source, key, seq, mark_new, dealt_by)
    latest = latest_by_key(source, key, seq)
    s = latest.select(F.struct("*").alias("s"), F.col(key).alias("_k"), F.lit(0).cast("bigint").alias("_spread"))
    known = F.when(has_key(target, key), F.col(key))
    t = target.select(F.struct("*").alias("t"), known.alias("_k"), spread_nulls(known, F.struct(*hashable(target))).alias("_spread"))
    return _updated(t.join(s, ["_k", "_spread"], "full_outer"), target, source, mark_new)


def _updated(merged: DataFrame, target: DataFrame, source: DataFrame, mark_new: str | None) -> DataFrame:
    """Rows from a target row ``t`` and the source row ``s`` of its key, either of which may be missing."""
    names = [*target.columns, *[c for c in source.columns if c not in target.columns]]

    def value(name: str):
        old = F.col(f"t.{name}") if name in target.columns else F.lit(None)
        if name not in source.columns:
            return old.alias(name)
        return F.when(F.col("s").isNotNull(), F.col(f"s.{name}")).otherwise(old).alias(name)

    marks = [F.col("t").isNull().alias(mark_new)] if mark_new else []
    return merged.select(*[value(n) for n in names], *marks)


def _merge_dealt(target: DataFrame, source: DataFrame, key: str, seq: str, mark_new: str | None, dealt_by: Callable[[Column, Column], Column]) -> DataFrame:
    """``merge_upsert`` by one exchange: both sides in one frame, its rows of a key one after the other, those of the source first, the last in front."""
    known = F.when(has_key(target, key), F.col(key))
    keyed = source.where(has_key(source, key))
    last = F.col(seq) if seq in source.columns else F.lit(0)
    s = keyed.select(F.lit(None).cast(target.schema).alias("t"), F.struct("*").alias("s"), F.col(key).alias("_raw"), F.col(key).alias("_k"), F.lit(0).cast("bigint").alias("_spread"), last.alias("_seq"))
    t = target.select(F.struct("*").alias("t"), F.lit(None).cast(source.schema).alias("s"), F.col(key).alias("_raw"), known.alias("_k"), spread_nulls(known, F.struct(*hashable(target))).alias("_spread"), F.lit(None).alias("_seq"))
    dealt = s.unionByName(t).withColumn("_to", dealt_by(F.col("_raw"), F.col("_spread"))).repartition("_to")
    group = W.partitionBy("_to", "_k", "_spread").orderBy(F.col("s").isNull(), F.col("_seq").desc())
    whole = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    merged = dealt.withColumns(
        {"s": F.first("s").over(whole), "_old": F.count("t").over(whole), "_rank": F.row_number().over(group)}
    ).where("t IS NOT NULL OR (_old = 0 AND _rank = 1)")
    return _updated(merged, target, source, mark_new)


def count_row(spark: SparkSession, target: str, before: int, after: int) -> DataFrame:
    """The report of a load whose counts are known."""
    return spark.range(1).select(
        F.lit(target).alias("target"), F.lit(before).cast("bigint").alias("before"), F.lit(after).cast("bigint").alias("after"),
        F.lit(after - before).cast("bigint").alias("delta"),
    )


def load_counts(target: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, after and their difference."""
    n_before = before.agg(F.count(F.lit(1)).alias("before"))
    n_after = after.agg(F.count(F.lit(1)).alias("after"))
    return n_before.select(F.lit(target).alias("target"), "before", n_after.scalar().alias("after")).withColumn(
        "delta", F.col("after") - F.col("before")
    )
