"""Files and stored tables in and out."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, case_of, query
from postsieve.operators import ingest
from postsieve.session import scratch_path
from postsieve.sources import csvfiles, store

CSV_OUT = """SELECT nullif(post_id, '') AS post_id, md5(content) AS body, likes, nullif(date, '') AS date, search_tag,
    coalesce(hashtags_json, '[]') AS hashtags,
    CASE ingest_seq % 4 WHEN 0 THEN '["a, b\\nc"]' WHEN 3 THEN '["좋아요"]' ELSE '[]' END AS comments FROM posts"""


def csv_posts(t):
    return t.posts_raw.drop("ingest_seq")


def written_csv(t) -> str:
    path = scratch_path(t.spark, "posts-csv")
    columns = ["post_id", "content", "likes", "hashtags", "comments", "date", "search_tag"]
    csvfiles.sink_posts_csv(csv_posts(t).select(*columns), path)
    return path


@query("scan_posts_csv", CSV_OUT, POSTS)
def scan_posts_csv(t):
    """Posts with multi-line texts written as CSV and scanned again."""
    back = csvfiles.scan_posts_csv(t.spark, written_csv(t))
    return back.select("post_id", F.md5("content").alias("body"), "likes", "date", "search_tag", "hashtags", "comments")


@query("sink_posts_csv", CSV_OUT, POSTS)
def sink_posts_csv(t):
    """The rows that a plain CSV reader finds in the written files."""
    path = written_csv(t)
    back = t.spark.read.options(header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8").csv(path)
    return back.select("post_id", F.md5("content").alias("body"), "likes", "date", "search_tag", "hashtags", "comments")


# Korean words that MS949 can write.
KOREAN = ["서울 맛집", "여수 식당", "협찬 광고", "할인 이벤트"]


@query(
    "scan_csv_encodings",
    f"""SELECT 'utf8' AS kind, md5(content) AS body FROM posts
        UNION ALL SELECT 'cp949', md5({case_of('ingest_seq', KOREAN)}) FROM posts
        UNION ALL SELECT 'latin1', md5(text) FROM posts""",
    POSTS,
)
def scan_csv_encodings(t):
    """One folder with files in three encodings, each holding every post."""
    path = scratch_path(t.spark, "mixed-csv")
    bodies = {
        "utf8": ("UTF-8", F.col("content")), "cp949": ("MS949", F.expr(case_of("ingest_seq", KOREAN))),
        "latin1": ("ISO-8859-1", F.concat(F.col("text"), F.lit(""))),
    }
    for kind, (encoding, body) in bodies.items():
        rows = t.posts.select(F.lit(kind).alias("post_id"), body.alias("content"))
        csvfiles.sink_posts_csv(rows, f"{path}/{kind}", encoding)
    back = csvfiles.scan_csv_encodings(t.spark, f"{path}/*", schema="post_id string, content string")
    return back.select(F.col("post_id").alias("kind"), F.md5("content").alias("body"))


@query(
    "load_posts",
    """SELECT ingest_seq, post_id, coalesce(CAST(trunc(try_cast(replace(likes, ',', '') AS DOUBLE)) AS BIGINT), 0) AS likes,
       CASE ingest_seq % 4 WHEN 0 THEN 3 WHEN 3 THEN 1 ELSE 0 END AS comment_count, strftime(try_cast(date AS TIMESTAMP), '%Y-%m-%d') AS created
       FROM posts QUALIFY coalesce(trim(post_id), '') = '' OR row_number() OVER (PARTITION BY post_id ORDER BY ingest_seq DESC) = 1""",
    POSTS,
)
def load_posts(t):
    """Stored posts, normalised, latest row per id."""
    root = scratch_path(t.spark, "posts")
    store.write_version(t.posts.withColumnRenamed("comments_text", "comments").drop("text"), root)
    posts = store.load_posts(t.spark, "auto", None, root, drop_duplicates_on="post_id")
    return posts.select("ingest_seq", "post_id", "likes", "comment_count", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


@query("store_find", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def store_find(t):
    return store.store_find(t["orders"], "o_orderstatus = 'F' AND o_totalprice > 200000", ["o_orderkey", "o_totalprice"])


@query("store_count", "SELECT count(*) AS n FROM events WHERE event_type = 'click'")
def store_count(t):
    return store.store_count(t["events"], F.col("event_type") == "click")


@query(
    "store_aggregate",
    "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source, lang",
)
def store_aggregate(t):
    return store.store_aggregate(
        t["documents"], "SELECT source, lang, count(*) AS n, sum(n_chars) AS chars FROM {collection} GROUP BY source, lang"
    )


@query(
    "serialize_lists",
    "SELECT ingest_seq, coalesce(hashtags_json, '[]') AS hashtags, coalesce(comments_text, '') AS comments FROM posts", POSTS,
)
def serialize_lists(t):
    mixed = t.posts_raw.select("ingest_seq", "hashtags").join(
        t.posts.select("ingest_seq", F.col("comments_text").alias("comments")), "ingest_seq"
    )
    return ingest.serialize_lists(mixed)


@query("sink_summary", "SELECT count(*) AS posts, count(DISTINCT source) AS sources FROM documents")
def sink_summary(t):
    path = scratch_path(t.spark, "summary")
    store.sink_summary(t["documents"].agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("source").alias("sources")), path)
    return t.spark.read.schema("posts bigint, sources bigint").json(path)
