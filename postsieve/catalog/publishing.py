"""Keyed merges and load reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, query
from postsieve.operators import dedupe, labels, publish
from postsieve.plans import jobs
from postsieve.session import cut_lineage, scratch_path

ITEMS = "SELECT l_orderkey * 2 AS o_orderkey, max(l_extendedprice) AS o_totalprice, count(*) AS n_items FROM lineitem GROUP BY l_orderkey"


@query(
    "merge_upsert",
    f"""SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey, o.o_custkey, o.o_orderstatus,
        CASE WHEN s.o_orderkey IS NULL THEN o.o_totalprice ELSE s.o_totalprice END AS o_totalprice, s.n_items
        FROM orders o FULL JOIN ({ITEMS}) s ON o.o_orderkey = s.o_orderkey""",
)
def merge_upsert(t):
    source = t["lineitem"].groupBy((F.col("l_orderkey") * 2).alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("o_totalprice"), F.count(F.lit(1)).alias("n_items")
    )
    target = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return publish.merge_upsert(target, source, "o_orderkey")


@query(
    "merge_upsert_events",
    """SELECT cast(u AS string) AS user, coalesce(e.value, c.c_acctbal) AS value, c.c_name AS name FROM
       (SELECT user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
       FULL JOIN customer c ON c.c_custkey = e.user_id, LATERAL (SELECT coalesce(c.c_custkey, e.user_id) AS u)""",
)
def merge_upsert_events(t):
    """Last event of each user (few, very frequent keys) into customers."""
    target = t["customer"].select(F.col("c_custkey").cast("string").alias("user"), F.col("c_acctbal").alias("value"), F.col("c_name").alias("name"))
    source = t["events"].select(F.col("user_id").cast("string").alias("user"), "value", F.col("event_id").alias("ingest_seq"))
    return publish.merge_upsert(target, source, "user").drop("ingest_seq")


@query("assert_unique_key", "SELECT post_id, count(*) AS cnt FROM posts WHERE trim(coalesce(post_id, '')) <> '' GROUP BY post_id HAVING count(*) > 1", POSTS)
def assert_unique_key(t):
    return dedupe.assert_unique_key(t.posts, "post_id")


MARKED_SQL = "marked AS (SELECT post_id, toxic FROM posts LEFT JOIN labels ON ingest_seq = doc_id WHERE coalesce(trim(post_id), '') <> '')"


def rated_posts(t):
    """Posts with rule_score and the map rule_why; is_ad is their mark. Marks are joined before the rules, as posts then still lie as the join wants them."""
    marks = t["labels"].select(F.col("doc_id").alias("ingest_seq"), F.col("toxic").alias("_mark"))
    rated = labels.apply_ad_rules(t.posts_raw.join(marks, "ingest_seq", "left"))
    return rated.drop("is_ad").withColumnRenamed("_mark", "is_ad")


@query(
    "load_targets",
    """SELECT 'all_post' AS target, count(DISTINCT post_id) AS before, count(DISTINCT post_id) AS after, 0 AS delta FROM marked
       UNION ALL SELECT 'non_ads', 0, count(DISTINCT post_id), count(DISTINCT post_id) FROM marked WHERE toxic = 0
       UNION ALL SELECT 'ads', 0, count(DISTINCT post_id), count(DISTINCT post_id) FROM marked WHERE toxic = 1""",
    POSTS, MARKED_SQL,
)
def load_targets(t):
    """All posts loaded, then all three tables: the first target does not grow again; an absent table is skipped."""
    root = scratch_path(t.spark, "targets")
    posts = cut_lineage(rated_posts(t), "rated")
    jobs.load_targets(t.spark, {"all_post": posts, "missing": None}, root)
    tables = {"all_post": posts, "non_ads": posts.where("is_ad = 0"), "ads": posts.where("is_ad = 1")}
    return jobs.load_targets(t.spark, tables, root)


@query(
    "load_counts",
    "SELECT 'customers' AS target, (SELECT count(*) FROM supplier) AS before, (SELECT count(*) FROM customer) AS after, (SELECT count(*) FROM customer) - (SELECT count(*) FROM supplier) AS delta",
)
def load_counts(t):
    return publish.load_counts("customers", t["supplier"], t["customer"])
