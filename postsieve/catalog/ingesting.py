"""Ingest: date fill, deduplication, order, incremental store."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, oracle_posts, query
from postsieve.catalog.columns import LIKES_SQL
from postsieve.operators import dedupe, enrich, ingest
from postsieve.plans import jobs
from postsieve.session import scratch_path
from postsieve.sources import store
from postsieve.streaming import ingest as stream

HAS_ID = "coalesce(trim(post_id), '') <> ''"
DEDUPED_SQL = f"""deduped AS (SELECT * FROM posts QUALIFY row_number() OVER (PARTITION BY {HAS_ID},
    CASE WHEN {HAS_ID} THEN post_id END, CASE WHEN {HAS_ID} THEN '' ELSE content END, CASE WHEN {HAS_ID} THEN '' ELSE date END
    ORDER BY ingest_seq DESC) = 1)"""
FILLED_SQL = f"""filled AS (SELECT * REPLACE (CASE WHEN {HAS_ID} THEN coalesce(
        last_value(nullif(trim(date), '') IGNORE NULLS) OVER (PARTITION BY post_id ORDER BY ingest_seq ROWS UNBOUNDED PRECEDING),
        first_value(nullif(trim(date), '') IGNORE NULLS) OVER (PARTITION BY post_id ORDER BY ingest_seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '')
      ELSE coalesce(date, '') END AS date) FROM posts)"""
RESOLVED_SQL = DEDUPED_SQL.replace("deduped AS (SELECT * FROM posts", "resolved AS (SELECT * FROM filled")


@query(
    "anti_seen_posts",
    f"""SELECT ingest_seq, post_id FROM posts WHERE NOT ({HAS_ID}) OR post_id NOT IN (SELECT concat('p', cast(l_orderkey AS string)) FROM lineitem)""",
    POSTS,
)
def anti_seen_posts(t):
    seen = t["lineitem"].select(F.concat(F.lit("p"), F.col("l_orderkey").cast("string")).alias("post_id"))
    return ingest.anti_seen_posts(t.posts, seen).select("ingest_seq", "post_id")


@query("fill_date", "SELECT ingest_seq, date FROM filled", POSTS, FILLED_SQL)
def fill_date(t):
    return ingest.fill_date(t.posts).select("ingest_seq", "date")


@query(
    "fill_date_events",
    """SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING),
         first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '') AS date
       FROM (SELECT *, CASE WHEN event_type = 'click' THEN cast(event_id AS string) END AS v FROM events)""",
)
def fill_date_events(t):
    posts = t["events"].select(
        F.col("event_id").alias("ingest_seq"), F.col("user_id").cast("string").alias("post_id"),
        F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).otherwise("").alias("date"),
    )
    return ingest.fill_date(posts).select(F.col("ingest_seq").alias("event_id"), "date")


@query(
    "dedupe_keep_last",
    "SELECT ingest_seq, md5(content) AS body FROM (SELECT doc_id AS ingest_seq, text AS content FROM documents) QUALIFY row_number() OVER (PARTITION BY content ORDER BY ingest_seq DESC) = 1",
)
def dedupe_keep_last(t):
    docs = t["documents"].select(F.col("doc_id").alias("ingest_seq"), F.col("text").alias("content"))
    return dedupe.dedupe_keep_last(docs, ["content"]).select("ingest_seq", F.md5("content").alias("body"))


@query(
    "dedupe_keep_first",
    "SELECT conv_id, turn, role FROM (SELECT *, conv_id * 100000 + turn AS s FROM conversations) QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY s) = 1",
)
def dedupe_keep_first(t):
    turns = t["conversations"].withColumn("s", F.col("conv_id") * 100000 + F.col("turn"))
    return dedupe.dedupe_keep_first(turns, ["conv_id", "role"], "s").select("conv_id", "turn", "role")


@query("split_dedupe_union", "SELECT ingest_seq, post_id, date FROM deduped", POSTS, DEDUPED_SQL)
def split_dedupe_union(t):
    return dedupe.dedupe_posts(t.posts).select("ingest_seq", "post_id", "date")


@query(
    "seen_keys",
    f"SELECT DISTINCT CASE WHEN {HAS_ID} THEN concat('id:', trim(post_id)) ELSE concat('c:', substr(sha1(content), 1, 16)) END AS key FROM posts", POSTS,
)
def seen_keys(t):
    return enrich.seen_keys(t.posts)


@query("distinct_keys", "SELECT DISTINCT user_id FROM events")
def distinct_keys(t):
    return dedupe.distinct_keys(t["events"], "user_id")


@query(
    "append_runs",
    "SELECT ingest_seq, post_id, search_tag, NULL AS extra FROM posts UNION ALL SELECT event_id, cast(user_id AS string), NULL, event_type FROM events",
    POSTS,
)
def append_runs(t):
    old = t.posts.select("ingest_seq", "post_id", "search_tag")
    new = t["events"].select(
        F.col("event_id").alias("ingest_seq"), F.col("user_id").cast("string").alias("post_id"), F.col("event_type").alias("extra")
    )
    return ingest.append_runs(old, new)


@query(
    "sort_by_date_desc",
    "SELECT ingest_seq, date FROM posts ORDER BY try_cast(date AS TIMESTAMP) DESC NULLS LAST, ingest_seq", POSTS,
)
def sort_by_date_desc(t):
    return ingest.sort_by_date_desc(t.posts.select("ingest_seq", "date"))


RESOLVED_OUT = "SELECT ingest_seq, post_id, date, md5(content) AS body, likes, search_tag FROM resolved"


@query("ingest_posts", RESOLVED_OUT, POSTS, FILLED_SQL, RESOLVED_SQL)
def ingest_posts(t):
    return ingest.append_and_dedupe(None, t.posts_raw).select("ingest_seq", "post_id", "date", F.md5("content").alias("body"), "likes", "search_tag")


AGE = r"\s*(?:\d+\s*(?:초|분|시간|일|주|개월|년)\s*전?|\d+\s*[smhdwSMHDW]|\d+\s*(?:hour|hours|hr|hrs|minute|minutes|min|mins|day|days|week|weeks))\s*$"
GUESS = """(CASE WHEN ingest_seq % 4 IN (0, 3) THEN 1 ELSE 0 END) * 5 + (CASE WHEN ingest_seq % 5 < 3 THEN 1 ELSE 0 END) * 2
    + CAST(concat('0x', substr(md5(coalesce(post_id, '')), 1, 6)) AS BIGINT) % 10 + 1"""
CLEANED_SQL = rf"""cleaned AS (SELECT * REPLACE (
    trim(regexp_replace(regexp_replace(content, '^[A-Za-z0-9._]{{2,30}}\b[\s:·•\-|]+', ''), '{AGE}', '', 'i')) AS content,
    CAST(coalesce({LIKES_SQL}, {GUESS}) AS VARCHAR) AS likes) FROM base)"""
JOB_OUT = "SELECT post_id, date, md5(content) AS body, likes, search_tag FROM resolved"


def ingested(t, *parts, **how):
    """The job in runs over parts of all posts."""
    root = scratch_path(t.spark, "posts-job")
    for part in parts:
        jobs.ingest_posts(t.spark, t.posts_raw.where(part), root, **how)
    return store.read_table(t.spark, root).select("post_id", "date", F.md5("content").alias("body"), "likes", "search_tag")


@query("job_ingest_posts", JOB_OUT, oracle_posts("base"), CLEANED_SQL, "posts AS (SELECT * FROM cleaned)", FILLED_SQL, RESOLVED_SQL)
def job_ingest_posts(t):
    """The job, with cleaning, in two runs over the halves of all posts; rows of the later run win over those of the first."""
    middle = t.posts_raw.agg((F.max("ingest_seq") / 2).alias("m")).scalar()
    return ingested(t, F.col("ingest_seq") <= middle, F.col("ingest_seq") > middle, skip_seen=False)


@query(
    "job_ingest_unseen", JOB_OUT, oracle_posts("base"), CLEANED_SQL,
    f"""posts AS (SELECT * REPLACE ((ingest_seq % 2) * 1000000000000 + ingest_seq AS ingest_seq) FROM cleaned c
        WHERE ingest_seq % 2 = 0 OR NOT ({HAS_ID}) OR post_id NOT IN (SELECT post_id FROM cleaned WHERE ingest_seq % 2 = 0 AND {HAS_ID}))""",
    FILLED_SQL, RESOLVED_SQL,
)
def job_ingest_unseen(t):
    """The job as it runs by default: even posts, then odd ones, of which those with a known id are skipped."""
    return ingested(t, F.col("ingest_seq") % 2 == 0, F.col("ingest_seq") % 2 == 1)


@query("ingest_stream", RESOLVED_OUT, POSTS, FILLED_SQL, RESOLVED_SQL)
def ingest_stream(t):
    """All posts through the streaming ingest in two landings with a compaction between; equals the batch result."""
    root = scratch_path(t.spark, "stream")
    middle = t.posts_raw.agg((F.max("ingest_seq") / 2).alias("m")).scalar()
    for part in (F.col("ingest_seq") <= middle, F.col("ingest_seq") > middle):
        t.posts_raw.where(part).write.mode("append").parquet(f"{root}/landing")
        stream.ingest_stream(t.spark, f"{root}/landing", root, f"{root}/checkpoint").awaitTermination()
        if not stream.store.versions(t.spark, f"{root}/base"):
            stream.compact(t.spark, root, upto=0)
    return stream.read_posts(t.spark, root).select("ingest_seq", "post_id", "date", F.md5("content").alias("body"), "likes", "search_tag")


@query("duplicate_groups", "SELECT md5(text) AS body, count(*) AS cnt, min(doc_id) AS keep_seq FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_groups(t):
    docs = t["documents"].select(F.col("doc_id").alias("ingest_seq"), "text")
    return dedupe.key_counts(docs, "text").select(F.md5("text").alias("body"), "cnt", "keep_seq")


@query(
    "duplicate_rows",
    "SELECT doc_id AS ingest_seq, k AS keep_seq FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS k FROM documents) WHERE doc_id > k",
)
def duplicate_rows(t):
    docs = t["documents"].select(F.col("doc_id").alias("ingest_seq"), "text")
    return dedupe.duplicate_rows(docs, "text").select("ingest_seq", "keep_seq")
