"""Incremental ingest: a log of resolved batches, read by merging them.

Each micro-batch is resolved by itself (dates filled, latest row per post) and written to its own folder, so its cost
grows with the batch and not with the store, and a batch that is replayed overwrites its own folder. Reading resolves the
log once more; compaction does that and starts a new base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postsieve.operators.dedupe import SEQ
from postsieve.operators.ingest import clean_posts, resolve_posts
from postsieve.schemas import POSTS_RAW
from postsieve.sources import store
from postsieve.sources.order import PLACE, number_rows, with_file, with_row

RUN = "batch"  # number of the micro-batch that brought a row; leads the order key, so a later batch wins whatever its numbers
ORDER = (RUN, SEQ)


def write_batch(batch: DataFrame, batch_id: int, root: str, clean: bool = False) -> None:
    """Resolve one batch into its folder of the log.

    Rows that bring no sequence number get the numbers behind those of all earlier batches: older files first, rows as they stand in them.
    """
    rows = clean_posts(batch) if clean else batch
    if SEQ in rows.columns:
        rows = rows.drop(*PLACE)
    else:
        bare = {"_at": F.lit(None).cast("timestamp"), "_file": F.lit(""), "_block": F.lit(0).cast("bigint")}
        filed = rows if "_file" in rows.columns else rows.withColumns(bare)
        rows = number_rows(with_row(filed), SEQ, next_number(batch.sparkSession, root, batch_id))
    path = f"{root}/log/{RUN}={batch_id}"
    resolve_posts(rows).write.mode("overwrite").parquet(path)
    written = batch.sparkSession.read.schema(f"{SEQ} bigint").parquet(path)  # the row of the highest number always survives
    following = written.agg((F.coalesce(F.max(SEQ), F.lit(-1)) + 1).alias("next"))
    following.write.mode("overwrite").json(f"{root}/numbers/{RUN}={batch_id}")


def next_number(spark: SparkSession, root: str, batch_id: int) -> int:
    """First number behind those of all earlier batches; one small row per batch is read."""
    if not store.exists(spark, f"{root}/numbers"):
        return 0
    told = spark.read.schema(f"next bigint, {RUN} bigint").json(f"{root}/numbers").where(F.col(RUN) < batch_id)
    return told.agg(F.coalesce(F.max("next"), F.lit(0))).first()[0]


def read_posts(spark: SparkSession, root: str, schema: T.StructType = POSTS_RAW) -> DataFrame:
    """Current posts: newest base plus the batches logged after it."""
    bases = store.versions(spark, f"{root}/base")
    base = store.read_table(spark, f"{root}/base", _filed(schema))
    if not store.exists(spark, f"{root}/log"):
        return base.drop(RUN)
    done = base_upto(spark, root, bases[-1]) if bases else -1
    return resolve_posts(base.unionByName(_log(spark, root, schema).where(F.col(RUN) > done)), ORDER).drop(RUN)


def _filed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RUN, T.LongType())])


def _log(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Logged batches; a filter on their number skips whole folders."""
    return spark.read.schema(_filed(schema)).parquet(f"{root}/log")


def base_upto(spark: SparkSession, root: str, version: int) -> int:
    """Last batch a base holds."""
    return spark.read.schema("upto bigint").json(f"{root}/base_upto/v={version:08d}").first()["upto"]


def compact(spark: SparkSession, root: str, upto: int, schema: T.StructType = POSTS_RAW) -> None:
    """Fold everything up to a finished batch into a new base; later batches stay in the log.

    The mark of what a base holds is written first: it has no effect before that base is committed.
    """
    bases = store.versions(spark, f"{root}/base")
    number = max(bases, default=0) + 1
    done = base_upto(spark, root, bases[-1]) if bases else -1
    span = _log(spark, root, schema).where((F.col(RUN) > done) & (F.col(RUN) <= upto))
    current = resolve_posts(store.read_table(spark, f"{root}/base", _filed(schema)).unionByName(span), ORDER)
    spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).write.mode("overwrite").json(
        f"{root}/base_upto/v={number:08d}"
    )
    store.write_version(current, f"{root}/base")


def ingest_stream(
    spark: SparkSession, landing: str, root: str, checkpoint: str, schema: T.StructType = POSTS_RAW,
    fmt: str = "parquet", files_per_batch: int | None = None, clean: bool = False,
) -> StreamingQuery:
    """Take in all new landing files, then stop. Run it again for files that came later."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        with_file(reader.load(landing))
        .writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root, clean))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
