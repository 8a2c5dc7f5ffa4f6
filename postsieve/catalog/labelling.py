"""Ad rules, labels and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS_NFKC, query
from postsieve.functions import adwords as words
from postsieve.functions.coerce import to_list
from postsieve.operators import labels
from postsieve.plans import jobs
from postsieve.session import scratch_path

GAP = r"[ \t\n\r._\-·]{0,2}"
KOREAN_SQL = "|".join(r"\s*".join(GAP.join(part) for part in phrase) for phrase in words.KEY_PHRASES)
ENGLISH_SQL = "|".join(r"\s*".join(p) for p in words.KEY_WORDS)
TAGS_SQL = "[" + ", ".join(f"'{t.lower().lstrip('#')}'" for t in words.AD_TAGS) + "]"
SIMPLE_SQL = " OR ".join(f"contains(lower(content), '{w.lower()}')" for w in words.SIMPLE_WORDS)
LINKS_SQL = "|".join(w.replace(".", r"\.") for w in words.LINKS)

SIGNALS_SQL = rf"""signals AS (SELECT *, list_has_any(tags, {TAGS_SQL}) AS h,
    regexp_matches(content, '(?i){KOREAN_SQL}') OR regexp_matches(content, '(?i)(^|[^\p{{L}}\p{{N}}_])(?:{ENGLISH_SQL})([^\p{{L}}\p{{N}}_]|$)') AS k,
    {SIMPLE_SQL} AS s0, regexp_matches(content, '(?i){"|".join(words.CTA_WORDS)}') AS c,
    regexp_matches(content, '(?i){LINKS_SQL}') AS l,
    regexp_matches(content, '(^|[^0-9])01[016789][-\s.]?\d{{3,4}}[-\s.]?\d{{4}}([^0-9]|$)') AS p
    FROM (SELECT *, list_concat(
        list_transform(coalesce(CAST(from_json(hashtags_json, '["VARCHAR"]') AS VARCHAR[]), []), lambda x: ltrim(lower(x), '#')),
        list_transform(regexp_extract_all(content, '#\S+'), lambda x: ltrim(lower(x), '#'))) AS tags FROM posts))"""
SCORED_SQL = """rated AS (SELECT *, NOT k AND s0 AS s,
    CAST(least(100, h::INT * 70 + k::INT * 30 + (NOT k AND s0)::INT * 20 + c::INT * 10 + l::INT * 15 + p::INT * 10) AS INT) AS rule_score FROM signals)"""
LABELLED_SQL = """labelled AS (SELECT *, CAST(h OR k OR s OR (l AND c) OR p OR rule_score >= 30 AS INT) AS is_ad,
    CAST(h OR ((k OR s) AND (l OR c OR p)) OR rule_score >= 40 AS INT) AS is_ad_balanced,
    CAST(h OR ((k OR s) AND (l OR c OR p)) OR rule_score >= 30 AS INT) AS is_ad_balanced_30 FROM rated)"""
RULES = (POSTS_NFKC, SIGNALS_SQL, SCORED_SQL, LABELLED_SQL)


def posts_with_tags(t):
    return t.posts.withColumn("hashtags", to_list(F.col("hashtags_json")))


def labelled(t, **kw):
    return labels.apply_ad_rules(posts_with_tags(t), **{"thr": 30, "mode": "recall", **kw})


@query("tags_union", "SELECT ingest_seq, array_to_string(list_sort(list_distinct(tags)), '|') AS tags FROM labelled", *RULES)
def tags_union(t):
    tags = labels.tags_union(F.col("hashtags"), F.col("content"))
    return posts_with_tags(t).select("ingest_seq", F.array_join(F.array_sort(F.array_distinct(tags)), "|").alias("tags"))


@query("tag_dictionary_match", "SELECT ingest_seq, h AS hit FROM labelled", *RULES)
def tag_dictionary_match(t):
    tags = labels.tags_union(F.col("hashtags"), F.col("content"))
    return posts_with_tags(t).select("ingest_seq", labels.tag_dictionary_match(tags).alias("hit"))


def _register(signal: str, column: str):
    @query(f"rule_{signal}", f"SELECT ingest_seq, {column} AS hit FROM labelled", *RULES)
    def rule(t):
        return labels.ad_signals(posts_with_tags(t)).select("ingest_seq", F.col(f"why_{signal}").alias("hit"))


for _signal, _column in {"hash": "h", "kw": "k", "kw_simple": "s", "cta": "c", "link": "l", "phone": "p"}.items():
    _register(_signal, _column)


@query(
    "ad_score",
    """SELECT ingest_seq, rule_score, array_to_string(list_sort(list_filter([CASE WHEN h THEN 'hash' END, CASE WHEN k THEN 'kw' END,
       CASE WHEN s THEN 'kw_simple' END, CASE WHEN c THEN 'cta' END, CASE WHEN l THEN 'link' END, CASE WHEN p THEN 'phone' END],
       lambda x: x IS NOT NULL)), '|') AS why FROM labelled""",
    *RULES,
)
def ad_score(t):
    return labelled(t).select("ingest_seq", "rule_score", F.array_join(F.array_sort(F.map_keys("rule_why")), "|").alias("why"))


@query("ad_label", "SELECT ingest_seq, is_ad, is_ad_balanced, is_ad_balanced_30 FROM labelled", *RULES)
def ad_label(t):
    rated = labelled(t, keep_signals=True)
    return rated.select(
        "ingest_seq", "is_ad", labels.ad_label(40, "balanced").alias("is_ad_balanced"),
        labels.ad_label(30, "balanced").alias("is_ad_balanced_30"),
    )


@query(
    "label_distribution",
    """SELECT search_tag, count(*) FILTER (is_ad = 1) AS pos, count(*) FILTER (is_ad = 0) AS neg, count(*) AS total,
       round(100.0e0 * count(*) FILTER (is_ad = 1) / count(*), 6) AS ratio FROM labelled GROUP BY search_tag""",
    *RULES,
)
def label_distribution(t):
    return labels.label_distribution(labelled(t), ["search_tag"]).withColumn("ratio", F.round("ratio", 6))


@query(
    "job_label_ads",
    """SELECT count(*) FILTER (is_ad = 1) AS pos, count(*) FILTER (is_ad = 0) AS neg, count(*) AS total,
       round(100.0e0 * count(*) FILTER (is_ad = 1) / count(*), 6) AS ratio FROM labelled""",
    *RULES,
)
def job_label_ads(t):
    """The job over all posts: labels written by partition, distribution read from what was written."""
    report, _ = jobs.label_ads(t.spark, t.posts_raw, scratch_path(t.spark, "labelled"), 30, "recall")
    return report.withColumn("ratio", F.round("ratio", 6))


@query(
    "top_rule_hits",
    "SELECT ingest_seq, rule_score, is_ad FROM labelled ORDER BY rule_score DESC, ingest_seq LIMIT 50", *RULES,
)
def top_rule_hits(t):
    return labels.top_rule_hits(labelled(t), 50, ["ingest_seq", "rule_score", "is_ad"])


@query(
    "split_by_label",
    "SELECT CASE is_ad WHEN 1 THEN 'ads' ELSE 'non_ads' END AS part, ingest_seq FROM (SELECT doc_id AS ingest_seq, toxic AS is_ad FROM labels) WHERE is_ad IN (0, 1)",
)
def split_by_label(t):
    marks = t["labels"].select(F.col("doc_id").alias("ingest_seq"), F.col("toxic").alias("is_ad"))
    rows = t["documents"].select(F.col("doc_id").alias("ingest_seq")).join(marks, "ingest_seq", "left")
    non_ads, ads = labels.split_by_label(rows)
    return non_ads.select(F.lit("non_ads").alias("part"), "ingest_seq").unionByName(ads.select(F.lit("ads").alias("part"), "ingest_seq"))


@query("filter_nonads", "SELECT ingest_seq, rule_score FROM labelled WHERE is_ad = 0", *RULES)
def filter_nonads(t):
    return labels.filter_nonads(labelled(t)).select("ingest_seq", "rule_score")
