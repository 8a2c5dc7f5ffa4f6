"""Ingest of crawled posts: cleaning, date fill, deduplication, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions import coerce, text
from postsieve.operators.dedupe import SEQ, dedupe_posts, distinct_keys
from postsieve.operators.skew import skew_join, spread_nulls
from postsieve.schemas import POSTS_RAW, dtype_of, require

CHUNK_ROWS = 1_000_000


def clean_posts(df: DataFrame) -> DataFrame:
    """Author and age stripped, composed Unicode, emoji removed, tags taken from the text, id and author from links, likes read.

    Likes that hold no number are estimated from comments and tags.
    """
    if "url" in df.columns:
        own = F.when(~text.is_blank(F.col("post_id")), F.col("post_id")) if "post_id" in df.columns else F.lit(None)
        df = df.withColumn("post_id", F.coalesce(own, text.post_id_from_url(F.col("url"))))
    if "hrefs" in df.columns and "username" not in df.columns:
        df = df.withColumn("username", text.first_handle(F.col("hrefs")))
    author = F.col("username") if "username" in df.columns else F.lit("")
    # One step each: a step names its text several times, and in one expression the steps before would be worked out as often.
    for step in (lambda c: text.strip_username(c, author), text.strip_relative_time, text.normalize_nfc):
        df = df.withColumn("content", step(F.col("content")))
    out = df
    if "hashtags" not in out.columns:
        out = out.withColumn("hashtags", text.hashtags_strict(F.col("content")))
    if "comments" in out.columns and dtype_of(out, "comments") == "array<string>":  # JSON keeps the parts apart, and no mark joins a quote
        out = out.withColumn("comments", F.from_json(text.normalize_nfc(F.to_json("comments")), "array<string>"))
    if {"likes", "post_id", "comments", "hashtags"} <= set(out.columns):
        count = lambda c: F.coalesce(F.size(c), F.lit(0)) if dtype_of(out, c).startswith("array") else F.lit(0)
        guess = text.estimate_likes(count("comments"), count("hashtags"), F.col("post_id"))
        out = out.withColumn("likes", F.coalesce(text.parse_like_count(F.col("likes").cast("string")), guess).cast("string"))
    return clear_emoji(out)


def read_lists(df: DataFrame) -> DataFrame:
    """List columns that a CSV brings as text become lists."""
    readers = {"hashtags": coerce.coerce_tags, "comments": coerce.to_list}
    return df.withColumns({c: read(F.col(c)) for c, read in readers.items() if c in df.columns and dtype_of(df, c) == "string"})


def as_raw(df: DataFrame) -> DataFrame:
    """Rows in the form of the post table: missing columns are NULL, others are left out."""
    value = lambda f: F.col(f.name) if f.name in df.columns else F.lit(None)
    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in POSTS_RAW.fields])


def clear_emoji(df: DataFrame) -> DataFrame:
    """Emoji out of text and list columns."""
    cleaned = {}
    for name in ("content", "hashtags", "comments", "restaurant_name", "address"):
        if name in df.columns:
            is_list = dtype_of(df, name).startswith("array")
            cleaned[name] = (text.remove_emoji_list if is_list else text.remove_emoji)(F.col(name))
    return df.withColumns(cleaned)


def serialize_lists(df: DataFrame, columns: tuple[str, ...] = ("hashtags", "comments")) -> DataFrame:
    """List columns to JSON text, text kept, anything else empty."""
    out = {}
    for name in columns:
        if name in df.columns:
            dtype = dtype_of(df, name)
            value = F.to_json(name) if dtype.startswith("array") else F.col(name) if dtype == "string" else F.lit("")
            out[name] = F.coalesce(value, F.lit(""))
    return df.withColumns(out)


def normalize_posts(df: DataFrame) -> DataFrame:
    """One projection: tags to a list, counts to numbers, dates to timestamps, label to 0/1."""
    out = {}
    if "hashtags" in df.columns and dtype_of(df, "hashtags") == "string":
        out["hashtags"] = coerce.coerce_tags(F.col("hashtags"))
    for name in ("likes", "views", "bookmarks"):
        if name in df.columns:
            out[name] = coerce.to_int(F.col(name))
    if "comments" in df.columns and "comment_count" not in df.columns:
        out["comment_count"] = coerce.comment_count(F.col("comments"), dtype_of(df, "comments"))
    dates = [F.col(c) for c in ("created_at", "date") if c in df.columns]
    if dates:
        out["created_at"] = F.coalesce(*[coerce.parse_dt(d.cast("string")) for d in dates])
    if "is_ad" in df.columns:
        out["is_ad"] = coerce.label_to_int(F.col("is_ad"))
    return df.withColumns(out)


def anti_seen_posts(new: DataFrame, seen: DataFrame) -> DataFrame:
    """New posts whose id is not known yet; posts without an id always pass."""
    pid = F.when(~text.is_blank(F.col("post_id")), F.col("post_id"))
    keyed = new.withColumn("_pid", pid).withColumn("_spread", spread_nulls(F.col("_pid"), F.col(SEQ)))
    known = distinct_keys(seen.select(pid.alias("_pid")), "_pid").withColumn("_spread", F.lit(0).cast("bigint"))
    return skew_join(keyed, known, ["_pid", "_spread"], "left_anti", [SEQ]).drop("_pid", "_spread")


def append_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def fill_date(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Blank dates take the last date before them in their post, else the next one after, else ''.

    A window over a whole post would put a hot post into one task. So the window runs inside chunks of
    ``ingest_seq``, and the dates at chunk edges, one row per post and chunk, are carried over by a second window.
    Posts without an id are not filled.
    """
    own = F.when(~text.is_blank(F.col("date")), F.col("date"))
    base = df.withColumns(
        {
            "_pid": F.when(~text.is_blank(F.col("post_id")), F.col("post_id")),
            "_own": own,
            "_chunk": F.floor(F.col(SEQ) / chunk_rows),
        }
    )
    keys = ["_pid", "_chunk"]
    own_seq = F.when(F.col("_own").isNotNull(), F.col(SEQ))
    # One row per post and chunk, combined map-side; a chunk without a date still needs its neighbours' dates.
    edges = base.where("_pid is not null").groupBy(*keys).agg(
        F.max_by("_own", own_seq).alias("_last"), F.min_by("_own", own_seq).alias("_first")
    )
    # The next date is the last one in falling order: a frame that only grows, so each row costs the same.
    across, across_back = (W.partitionBy("_pid").orderBy(o).rowsBetween(W.unboundedPreceding, -1) for o in (F.asc("_chunk"), F.desc("_chunk")))
    carried = (
        edges.select(
            *keys,
            F.last("_last", True).over(across).alias("_carry_fwd"),
            F.last("_first", True).over(across_back).alias("_carry_back"),
        )
        .where("_carry_fwd is not null or _carry_back is not null")
        .withColumn("_spread", F.lit(0).cast("bigint"))
    )
    spread = base.withColumn("_spread", spread_nulls(F.col("_pid"), F.col(SEQ)))
    inside, inside_back = (W.partitionBy(*keys, "_spread").orderBy(o).rowsBetween(W.unboundedPreceding, 0) for o in (F.asc(SEQ), F.desc(SEQ)))
    filled = spread.withColumns({"_fwd": F.last("_own", True).over(inside), "_back": F.last("_own", True).over(inside_back)}).join(carried, [*keys, "_spread"], "left")
    with_id = F.coalesce("_fwd", "_carry_fwd", "_back", "_carry_back", F.lit(""))
    date = F.when(F.col("_pid").isNull(), F.coalesce("_own", F.lit(""))).otherwise(with_id)
    return filled.withColumn("date", date).select(*df.columns)


def resolve_posts(df: DataFrame, order: tuple[str, ...] = (SEQ,)) -> DataFrame:
    """Date fill and keep-last in one aggregate.

    The row that survives is the last of its post by ``order``, a composite key of columns, and the fill gives it the last known
    date of the post. Both are plain maxima, combined map-side, so this is the form the jobs use; it may also be
    applied to its own results again, which is what the incremental store relies on.
    """
    missing = text.is_blank(F.col("post_id"))
    dated = ~text.is_blank(F.col("date"))
    date = F.when(dated, F.col("date")).otherwise("")
    keyed = df.withColumns(
        {
            "_id": F.when(~missing, F.col("post_id")),
            "_content": F.when(missing, F.col("content")),
            "_date": F.when(missing, date),
            "_dated": F.when(dated & ~missing, F.struct(*order, "date")),
        }
    )
    keys = ["_id", "_content", "_date"]
    row = F.struct(*[F.col(c) for c in df.columns])
    best = keyed.groupBy(F.xxhash64(*keys).alias("_kh"), *keys).agg(
        F.max_by(row, F.struct(*order)).alias("row"), F.max("_dated").alias("dated")
    )
    filled = F.coalesce("dated.date", "_date", F.lit(""))
    columns = [filled.alias("date") if c == "date" else F.col(f"row.{c}").alias(c) for c in df.columns]
    return best.select(*columns)


def sort_by_date_desc(df: DataFrame) -> DataFrame:
    """Newest first, unreadable dates last. The sequence in the sort key lets one hot date be split."""
    return df.orderBy(coerce.parse_dt(F.col("date")).desc_nulls_last(), F.col(SEQ))


def drop_blank_content(df: DataFrame, content: str = "content") -> DataFrame:
    """Trimmed text, rows without text removed."""
    require(df, content)
    return df.withColumn(content, text.strip(F.col(content))).where(F.col(content) != "")


def append_and_dedupe(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """One ingest step: previous and new posts, dates filled, latest row per post."""
    return resolve_posts(append_runs(old, new) if old is not None else new)


__all__ = [
    "anti_seen_posts", "append_and_dedupe", "append_runs", "clean_posts", "clear_emoji", "dedupe_posts",
    "drop_blank_content", "fill_date", "normalize_posts", "resolve_posts", "serialize_lists", "sort_by_date_desc",
]
