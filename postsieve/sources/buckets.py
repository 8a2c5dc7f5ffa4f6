"""Tables laid out by hash buckets of their key, so that a merge reads and rewrites the buckets it touches and no others.

The layout is Spark's own partitioning: ``v=<layout>/_of=<buckets>/_bucket=<n>``, written with dynamic partition overwrite, whose job
stages all touched buckets and puts them in place together at its commit. ``store.read_table`` reads such a table like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.publish import has_key, hashable, latest_by_key, merge_upsert
from postsieve.sources import store

ROWS_PER_BUCKET = 250_000
TASKS_PER_BUCKET = 16  # at most; a merge sorts the rows of a task
HOT = 20_000  # rows of one key from which on they are cut to the last before they are dealt out
OF, BUCKET = store.BUCKET_COLUMNS


@dataclass(frozen=True)
class Merged:
    """What a merge did: rows before and after, buckets there are and buckets rewritten."""

    before: int
    after: int
    buckets: int
    touched: int


def bucket_of(key: Column, of: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int")


def buckets_in(spark: SparkSession, root: str) -> int:
    """Buckets of the newest layout; 0 where there is no table, or one without buckets."""
    found = store.versions(spark, root)
    if not found:
        return 0
    return max((int(n[len(OF) + 1 :]) for n in store.names_in(spark, f"{root}/v={found[-1]:08d}") if n.startswith(f"{OF}=")), default=0)


def _dealt_by(of: int) -> Callable[[Column, Column], Column]:
    """Number of the task that gets a row: its bucket, and a part of it by other bits of the key, or by ``spread`` where that is not 0."""

    def number(key: Column, spread: Column) -> Column:
        part = F.when(spread == 0, F.shiftrightunsigned(F.xxhash64(key), 40)).otherwise(spread)
        return bucket_of(key, of) * F.lit(TASKS_PER_BUCKET) + F.pmod(part, F.lit(TASKS_PER_BUCKET)).cast("int")

    return number


def _write(df: DataFrame, root: str, version: int, key: str, of: int, mode: str) -> dict:
    """Write these rows, dealt out by ``_dealt_by``, as a whole layout (static), or over its buckets that have some (dynamic).

    How many there are, and how many of them are new, is observed by the tasks that write. Only whole layouts get the mark by
    which ``store.versions`` knows them as committed.
    """
    seen = Observation()
    placed = df.withColumns({OF: F.lit(of), BUCKET: bucket_of(F.col(key), of)})
    counted = placed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_new").alias("new"))
    counted.drop("_new").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(OF, BUCKET).parquet(f"{root}/v={version:08d}")
    return seen.get


def _keys_of(source: DataFrame, key: str, of: int, hot: int) -> tuple[int, list[int], DataFrame]:
    """Number of keys, buckets they are in, and the rows with a key; only the last of each key with more than ``hot`` rows.

    Only keys are shuffled for this. At most one number for every ``hot`` rows, and the numbers of buckets, reach the driver.
    """
    keyed = source.where(has_key(source, key))
    counts = keyed.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    many = F.collect_list(F.when(F.col("n") > hot, F.xxhash64("_k")))
    found = counts.agg(F.count(F.lit(1)).alias("keys"), F.collect_set(bucket_of(F.col("_k"), max(of, 1))).alias("buckets"), many.alias("hot")).first()
    if found["hot"]:
        is_hot = F.xxhash64(key).isin(found["hot"])
        keyed = keyed.where(~is_hot).unionByName(latest_by_key(keyed.where(is_hot), key))
    return found["keys"], found["buckets"], keyed


def _dealt(df: DataFrame, key: str, of: int) -> DataFrame:
    spread = F.when(F.col(key).isNull(), F.xxhash64(*hashable(df))).otherwise(F.lit(0))
    return df.withColumn("_to", _dealt_by(of)(F.col(key), spread)).repartition("_to").drop("_to")


def _merged(target: DataFrame, rows: DataFrame, key: str, of: int) -> DataFrame:
    """``merge_upsert``, its result dealt out for ``of`` buckets. Keys of two types are compared by a join, as Spark compares them."""
    if dict(target.dtypes)[key] == dict(rows.dtypes)[key]:
        return merge_upsert(target, rows, key, mark_new="_new", dealt_by=_dealt_by(of))
    return _dealt(merge_upsert(target, rows, key, mark_new="_new"), key, of)


def upsert(spark: SparkSession, source: DataFrame, root: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET, hot: int = HOT) -> Merged:
    """``merge_upsert`` of a source into the table at ``root``, on the buckets of its keys.

    A table that is not there yet, or is not in buckets, is laid out by its number of rows, and again where buckets hold twice
    what they should or the source brings new columns or types; that rewrites it as the next version. The buckets touched are a list of
    at most as many numbers as there are buckets. Rows of the source and of the touched buckets are moved once. One load of a table at a time.
    """
    of, layouts = buckets_in(spark, root), store.versions(spark, root)
    old = store.read_table(spark, root, T.StructType(source.schema.fields))
    before = old.count()  # from the files' footers
    keys, numbers, rows = _keys_of(source, key, of, hot)
    same = {c: t for c, t in merge_upsert(old, source, key).dtypes} == dict(old.dtypes)
    if of and same:
        if not numbers:
            return Merged(before, before, of, 0)
        there = store.read_table(spark, root, buckets=numbers)
        done = _write(_merged(there, rows, key, of), root, layouts[-1], key, of, "dynamic")
        after = before + done["new"]
        if after <= 2 * rows_per_bucket * of:
            return Merged(before, after, of, len(numbers))
        wider = max(1, -(-after // rows_per_bucket))
        merged = _dealt(store.read_table(spark, root).withColumn("_new", F.lit(False)), key, wider)
    else:
        wider = max(1, -(-(before + keys) // rows_per_bucket))
        merged = _merged(old, rows, key, wider)
    done = _write(merged, root, (layouts[-1] if layouts else 0) + 1, key, wider, "static")
    return Merged(before, done["rows"], wider, wider)
