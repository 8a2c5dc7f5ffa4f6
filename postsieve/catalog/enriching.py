"""Enrichment state: what is pending, answers attached, results and failures merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, query, raw_form
from postsieve.catalog.columns import JUDGED_SQL
from postsieve.operators import enrich
from postsieve.operators.dedupe import dedupe_keep_last
from postsieve.plans import jobs
from postsieve.schemas import EXTRACT_FAILURES
from postsieve.session import scratch_path
from postsieve.sources import store

KEYED_SQL = """keyed AS (SELECT * , CASE WHEN coalesce(trim(post_id), '') <> '' THEN concat('id:', trim(post_id)) ELSE concat('c:', substr(sha1(content), 1, 16)) END AS key FROM judged),
    unique_posts AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY content ORDER BY ingest_seq DESC) = 1),
    answers AS (SELECT key, any_value(response) AS response FROM (SELECT key, response, row_number() OVER (PARTITION BY key ORDER BY ingest_seq DESC) AS r FROM keyed) WHERE r = 1 GROUP BY key)"""
# State before the run: results and failures of orders, whose numbers are post ids, too.
STATE_SQL = """ok_before AS (SELECT DISTINCT concat('id:p', cast(o_orderkey AS string)) AS key FROM orders WHERE o_orderstatus = 'F'),
    failed_before AS (SELECT concat('id:p', cast(o_orderkey AS string)) AS key, 1 + o_custkey % 3 AS attempts FROM orders WHERE o_orderstatus = 'O')"""
PENDING_SQL = """pending AS (SELECT * FROM unique_posts WHERE key NOT IN (SELECT key FROM ok_before) AND key NOT IN (SELECT key FROM failed_before))"""
RETRY_SQL = PENDING_SQL.replace(" AND key NOT IN (SELECT key FROM failed_before)", "")
# The answer of a key is the response of its latest post.
ATTACHED_SQL = JUDGED_SQL.replace("judged AS", "attached AS").replace(
    "FROM posts)", "FROM (SELECT p.* EXCLUDE (response, j, place_count, n_places, name, confidence), a.response FROM pending p LEFT JOIN answers a USING (key)))"
)


def state(t):
    orders = t["orders"].select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("post_id"), "o_custkey", "o_orderstatus")
    done = orders.where("o_orderstatus = 'F'").select("post_id", F.lit("").alias("content"))
    failed = orders.where("o_orderstatus = 'O'").select(
        F.concat(F.lit("id:"), "post_id").alias("key"), "post_id", F.lit("").alias("content_hash"),
        (1 + F.col("o_custkey") % 3).cast("int").alias("attempts"), F.to_timestamp(F.lit("2025-08-01 00:00:00")).alias("last_ts"),
        F.lit("").alias("sample_tag"),
    )
    return done, failed


def responses(t):
    keyed = enrich.with_key(t.posts_unmoved).select("key", "response", "ingest_seq")
    return dedupe_keep_last(keyed, ["key"]).select("key", "response")


def judged(t, retry=False):
    done, failed = state(t)
    pending = enrich.pending_posts(t.posts_unmoved, done, failed, retry)
    return failed, enrich.with_place(enrich.join_llm_response(pending, responses(t), enrich.hot_post_keys(t.posts_unmoved)))


@query("anti_processed", "SELECT ingest_seq, key FROM pending", POSTS, JUDGED_SQL, KEYED_SQL, STATE_SQL, PENDING_SQL)
def anti_processed(t):
    return enrich.pending_posts(t.posts_unmoved, *state(t)).select("ingest_seq", "key")


@query("anti_processed_retry", "SELECT ingest_seq, key FROM pending", POSTS, JUDGED_SQL, KEYED_SQL, STATE_SQL, RETRY_SQL)
def anti_processed_retry(t):
    return enrich.pending_posts(t.posts_unmoved, *state(t), retry_failed=True).select("ingest_seq", "key")


@query(
    "join_llm_response", "SELECT ingest_seq, key, response FROM pending LEFT JOIN (SELECT key, response AS r FROM answers) USING (key)".replace("response FROM", "r AS response FROM"),
    POSTS, JUDGED_SQL, KEYED_SQL, STATE_SQL, PENDING_SQL,
)
def join_llm_response(t):
    return judged(t)[1].select("ingest_seq", "key", "response")


@query(
    "merge_extracted",
    """SELECT ingest_seq, name, confidence FROM attached WHERE place_count = 1 AND n_places > 0
       UNION ALL SELECT doc_id, 'old', NULL FROM (SELECT max(doc_id) AS doc_id, text FROM documents GROUP BY text)""",
    POSTS, JUDGED_SQL, KEYED_SQL, STATE_SQL, PENDING_SQL, ATTACHED_SQL,
)
def merge_extracted(t):
    old = t["documents"].select(
        F.col("text").alias("content"), F.array(F.lit("old")).alias("restaurant_name"), F.col("doc_id").alias("ingest_seq")
    )
    merged = enrich.merge_extracted(old, enrich.extracted_rows(judged(t)[1]))
    return merged.select(
        "ingest_seq", F.coalesce(F.get("restaurant_name", 0), F.lit("")).alias("name"), F.col("model_confidence").alias("confidence")
    )


FAIL_MERGE_SQL = """SELECT coalesce(f.key, n.key) AS key, CASE WHEN n.failed THEN coalesce(f.attempts, 0) + 1 ELSE f.attempts END AS attempts,
    CASE WHEN n.failed THEN '2025-09-01' ELSE '2025-08-01' END AS day, CASE WHEN n.failed THEN n.tag ELSE '' END AS sample_tag
    FROM failed_before f FULL JOIN (SELECT key, bool_or(NOT (place_count = 1 AND n_places > 0)) AS failed,
        arg_max(search_tag, ingest_seq) FILTER (NOT (place_count = 1 AND n_places > 0)) AS tag FROM attached GROUP BY key) n USING (key)
    WHERE n.failed OR n.failed IS NULL"""


@query("merge_fail_log", FAIL_MERGE_SQL, POSTS, JUDGED_SQL, KEYED_SQL, STATE_SQL, RETRY_SQL, ATTACHED_SQL)
def merge_fail_log(t):
    failed, rows = judged(t, retry=True)
    merged = enrich.merge_fail_log(failed, rows, F.to_timestamp(F.lit("2025-09-01 00:00:00")))
    return merged.select("key", F.col("attempts").cast("bigint").alias("attempts"), F.date_format("last_ts", "yyyy-MM-dd").alias("day"), "sample_tag")


RAW_FAILURES = """SELECT CASE WHEN event_type = 'error' THEN ' ' ELSE concat('id:', cast(user_id AS string)) END AS key,
    cast(user_id AS string) AS post_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE cast(event_id % 4 AS string) END AS attempts, event_id FROM events"""


@query(
    "read_fail_log",
    f"""SELECT key, post_id, coalesce(nullif(cast(attempts AS INT), 0), 1) AS attempts FROM ({RAW_FAILURES}) WHERE trim(key) <> ''
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1""",
)
def read_fail_log(t):
    """Loose rows through the reader, the table written and read back."""
    loose = t["events"].selectExpr(
        "CASE WHEN event_type = 'error' THEN ' ' ELSE concat('id:', cast(user_id AS string)) END AS key",
        "cast(user_id AS string) AS post_id", "CASE WHEN event_id % 2 = 0 THEN NULL ELSE cast(event_id % 4 AS string) END AS attempts",
        "event_id", "cast(NULL AS string) AS content_hash", "cast(ts AS string) AS last_ts", "event_type AS sample_tag",
    )
    root = scratch_path(t.spark, "failures")
    store.write_version(enrich.read_fail_log(loose, "event_id"), root)
    return store.read_table(t.spark, root, EXTRACT_FAILURES).select("key", "post_id", "attempts")


@query(
    "enrich_posts",
    """SELECT count(*) AS extracted, (SELECT count(*) FROM (SELECT key FROM attached GROUP BY key HAVING bool_or(NOT (place_count = 1 AND n_places > 0)))) AS failed
       FROM (SELECT DISTINCT content FROM attached WHERE place_count = 1 AND n_places > 0)""",
    POSTS, JUDGED_SQL, KEYED_SQL, "pending AS (SELECT * FROM unique_posts)", ATTACHED_SQL,
)
def enrich_posts(t):
    """The whole job from empty state, run twice: the second run finds nothing to do."""
    root = scratch_path(t.spark, "enrich")
    for _ in range(2):
        jobs.enrich_posts(t.spark, raw_form(t.posts_unmoved), responses(t), f"{root}/extracted", f"{root}/failures")
    extracted = store.read_table(t.spark, f"{root}/extracted").agg(F.count(F.lit(1)).alias("extracted"))
    failed = store.read_table(t.spark, f"{root}/failures").agg(F.count(F.lit(1)).alias("failed"))
    return extracted.select("extracted", failed.scalar().alias("failed"))
