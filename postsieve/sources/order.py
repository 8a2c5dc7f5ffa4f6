"""Row order of files: older files first, rows as they stand in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.session import cut_lineage

PLACE = ("_at", "_file", "_block", "_row")


def with_place(df: DataFrame) -> DataFrame:
    """Adds where each row comes from. Call it on the read itself: a reader packs files into tasks by size, not by age."""
    return with_row(with_file(df))


def with_file(df: DataFrame) -> DataFrame:
    """Adds time and name of the file, and where in it the split begins that holds the row."""
    return df.select(
        "*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def with_row(df: DataFrame) -> DataFrame:
    return df.withColumn("_row", F.monotonically_increasing_id())


def number_rows(df: DataFrame, seq: str, start: Column | int = 0) -> DataFrame:
    """Replaces the place by a number from ``start`` on that rises with (file time, file name, split, row).

    Row ids only rise inside one task, and jump by 2^33 from one to the next. So rows are numbered by (split, task), one row of
    each being summed in one place; no more numbers are used than there are rows, but for those that were filtered out before.
    The rows are written once, so that their places stay as they are.
    """
    rows = cut_lineage(df, "placed").withColumn("_task", F.shiftright("_row", 33))
    keys = ["_at", "_file", "_block", "_task"]
    parts = rows.groupBy(*keys).agg(F.min("_row").alias("_first"), (F.max("_row") - F.min("_row") + 1).alias("_span"))
    before = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("_file", "_block", "_task", "_first", F.coalesce(F.sum("_span").over(before), F.lit(0)).alias("_start"))
    number = F.lit(start) + F.col("_start") + F.col("_row") - F.col("_first")
    return rows.join(starts, ["_file", "_block", "_task"]).withColumn(seq, number.cast("bigint")).drop(*PLACE, "_task", "_first", "_start")
