"""Stored collections: versioned Parquet tables, filtered reads, counts and aggregates.

A table is a folder of version folders. A version counts once its job has committed (``_SUCCESS``), readers take the
newest such version, and a merge writes the next one. So a table is never overwritten while it is read, and a lost job
leaves the last version in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.text import strip
from postsieve.operators.dedupe import dedupe_keep_last
from postsieve.operators.ingest import normalize_posts
from postsieve.schemas import POSTS_CSV
from postsieve.sources.csvfiles import scan_in_order
from postsieve.sources.order import PLACE, number_rows

BUCKET_COLUMNS = ("_of", "_bucket")  # partition columns of tables in buckets


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def write_observed(df: DataFrame, root: str, **counts: Column) -> tuple[int, dict]:
    """Write the next version; aggregates of its rows are observed by the tasks that write, so nothing is read again.

    Rows are dealt out before, so that a map task that runs twice, after an executor is lost, is not counted twice.
    """
    seen = Observation()
    version = write_version(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), root)
    return version, seen.get


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending."""
    numbers = sorted(int(n[2:]) for n in names_in(spark, root) if n.startswith("v="))
    return [n for n in numbers if exists(spark, f"{root}/v={n:08d}/_SUCCESS")]


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Write the next version and return its number."""
    number = max(versions(df.sparkSession, root), default=0) + 1
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/v={number:08d}")
    return number


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Newest version; an empty frame of the schema when there is none. Of a table in buckets, only the files of those asked for."""
    found = versions(spark, root)
    if not found:
        if schema is None:
            raise FileNotFoundError(f"no committed version under {root}")
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(f"{root}/v={found[-1]:08d}")
    if buckets is not None:
        df = df.where(F.col(BUCKET_COLUMNS[1]).isin(buckets))
    return df.drop(*BUCKET_COLUMNS)


def store_find(df: DataFrame, where: str | Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """Filtered, projected read. On a Parquet frame both reach the scan."""
    out = df.where(where) if where is not None else df
    return out.select(*columns) if columns else out


def store_count(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    return store_find(df, where).agg(F.count(F.lit(1)).alias("n"))


def store_aggregate(df: DataFrame, query: str, name: str = "collection") -> DataFrame:
    """Caller's SQL over the collection, which it calls ``{name}``."""
    return df.sparkSession.sql(query.replace("{" + name + "}", "{df}"), df=df)


def read_landing(
    spark: SparkSession, csv_path: str, where: str | Column | None = None, columns: list[str] | None = None, seq: str = "ingest_seq"
) -> DataFrame:
    """CSV rows as they stand in the files, numbered by the time and name of their file, then by row: the input of an ingest run."""
    found = scan_in_order(spark, csv_path, POSTS_CSV)
    if "_row" not in found.columns:  # no file
        return found.withColumn(seq, F.lit(0).cast("bigint"))
    return number_rows(store_find(found, where, [*columns, *PLACE] if columns else None), seq)


def load_posts(
    spark: SparkSession, source: str = "auto", csv_path: str | None = None, store_root: str | None = None,
    where: str | Column | None = None, columns: list[str] | None = None, drop_duplicates_on: str | None = None,
    seq: str = "ingest_seq",
) -> DataFrame:
    """Posts from CSV or store, normalised, and on request the latest row per key.

    ``auto`` takes the CSV when it exists. CSV rows are numbered by the time and name of their file, then as they stand in it. Rows
    whose key is missing or blank have no duplicates.
    """
    if source not in {"auto", "csv", "store"}:
        raise ValueError("source must be auto, csv or store")
    if source == "auto":
        source = "csv" if csv_path and exists(spark, csv_path) else "store"
    if source == "csv":
        if not csv_path:
            raise ValueError("csv_path is needed for source csv")
        df = read_landing(spark, csv_path, where, columns, seq)
    else:
        if not store_root:
            raise ValueError("store_root is needed for source store")
        df = store_find(read_table(spark, store_root), where, columns)
    df = normalize_posts(df)
    if drop_duplicates_on and drop_duplicates_on in df.columns:
        key = F.col(drop_duplicates_on)
        missing = key.isNull() | (strip(key.cast("string")) == "")
        df = dedupe_keep_last(df.where(~missing), [drop_duplicates_on], seq).unionByName(df.where(missing))
    return df


def sink_summary(summary: DataFrame, path: str) -> None:
    """One-row summary as JSON."""
    summary.write.mode("overwrite").json(path)
