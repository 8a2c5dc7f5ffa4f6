"""Text, coercion and answer expressions, each over all posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, POSTS_NFKC, query
from postsieve.functions import answers, coerce, text
from postsieve.operators import enrich, features, ingest, places
from postsieve.schemas import conform, pick_content_col

STRIPPED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')".format
ROAD = r"[가-힣]+\s[가-힣]+\s[가-힣0-9\-]+(?:로|길)\s*\d+(?:-\d+)?"


@query("normalize_nfkc", "SELECT ingest_seq, md5(content) AS norm, length(content) AS n FROM posts", POSTS_NFKC)
def normalize_nfkc(t):
    norm = text.normalize_nfkc(F.col("content"))
    return t.posts.select("ingest_seq", norm.alias("t")).select("ingest_seq", F.md5("t").alias("norm"), F.length("t").cast("bigint").alias("n"))


@query(
    "normalize_nfc",
    "SELECT ingest_seq, md5(nfc_normalize(concat(content, chr(233), 'e', chr(769)))) AS norm FROM posts", POSTS,
)
def normalize_nfc(t):
    mixed = F.concat("content", F.lit("\u00e9e\u0301"))
    return t.posts.select("ingest_seq", F.md5(text.normalize_nfc(mixed)).alias("norm"))


@query(
    "strip_username",
    r"""SELECT ingest_seq, md5(CASE WHEN lang = 'en' THEN regexp_replace(content, '^[\s:·•\-|]+', '')
        ELSE regexp_replace(content, '^[A-Za-z0-9._]{2,30}\b[\s:·•\-|]+', '') END) AS body FROM posts""",
    POSTS,
)
def strip_username(t):
    named = t.posts.withColumn("user", F.when(F.col("lang") == "en", F.concat("lang", "ingest_seq")))
    line = F.when(F.col("lang") == "en", F.concat(F.upper("user"), F.lit(" : "), F.ltrim("content"))).otherwise(F.col("content"))
    return named.select("ingest_seq", F.md5(text.strip_username(line, F.col("user"))).alias("body"))


@query(
    "strip_relative_time",
    r"""SELECT ingest_seq, md5(trim(regexp_replace(
          content || CASE ingest_seq % 5 WHEN 0 THEN ' 3시간 전' WHEN 1 THEN ' 2w ' WHEN 2 THEN ' 5 days' WHEN 3 THEN '12 Hrs' ELSE '' END,
          '\s*(?:\d+\s*(?:초|분|시간|일|주|개월|년)\s*전?|\d+\s*[smhdwSMHDW]|\d+\s*(?:hour|hours|hr|hrs|minute|minutes|min|mins|day|days|week|weeks))\s*$',
          '', 'i'))) AS body FROM posts""",
    POSTS,
)
def strip_relative_time(t):
    ages = F.expr("CASE ingest_seq % 5 WHEN 0 THEN ' 3시간 전' WHEN 1 THEN ' 2w ' WHEN 2 THEN ' 5 days' WHEN 3 THEN '12 Hrs' ELSE '' END")
    return t.posts.select("ingest_seq", F.md5(text.strip_relative_time(F.concat("content", ages))).alias("body"))


@query(
    "hashtags_strict",
    r"SELECT ingest_seq, array_to_string(regexp_extract_all(content || '#a,#b #c\d', '#[^\s#,\\]+'), '|') AS tags FROM posts",
    POSTS,
)
def hashtags_strict(t):
    return t.posts.select(
        "ingest_seq", F.array_join(text.hashtags_strict(F.concat("content", F.lit(r"#a,#b #c\d"))), "|").alias("tags")
    )


@query(
    "hashtags_loose",
    r"SELECT ingest_seq, array_to_string(regexp_extract_all(content, '#\S+'), '|') AS tags FROM posts", POSTS,
)
def hashtags_loose(t):
    return t.posts.select("ingest_seq", F.array_join(text.hashtags_loose(F.col("content")), "|").alias("tags"))


@query(
    "coerce_tags",
    r"""SELECT ingest_seq, array_to_string(CASE ingest_seq % 3 WHEN 0 THEN coalesce(CAST(from_json(hashtags_json, '["VARCHAR"]') AS VARCHAR[]), [])
        WHEN 1 THEN regexp_extract_all(content, '#\S+') ELSE [] END, '|') AS tags FROM posts""",
    POSTS,
)
def coerce_tags(t):
    mixed = F.expr("CASE ingest_seq % 3 WHEN 0 THEN hashtags_json WHEN 1 THEN content ELSE '{\"a\": \"#x\"}' END")
    return t.posts.select("ingest_seq", F.array_join(coerce.coerce_tags(mixed), "|").alias("tags"))


@query(
    "fold_tag",
    r"""SELECT ingest_seq, array_to_string(list_transform(regexp_extract_all(content || ' ##AD #Tag', '#\S+'),
        lambda x: ltrim(lower(x), '#')), '|') AS tags FROM posts""",
    POSTS,
)
def fold_tag(t):
    tags = text.hashtags_loose(F.concat("content", F.lit(" ##AD #Tag")))
    return t.posts.select("ingest_seq", F.array_join(text.fold_tags(tags), "|").alias("tags"))


@query(
    "remove_emoji",
    "SELECT ingest_seq, md5(content || ' ★end') AS body, coalesce(array_to_string(CAST(from_json(hashtags_json, '[\"VARCHAR\"]') AS VARCHAR[]), '|'), '') AS tags FROM posts",
    POSTS,
)
def remove_emoji(t):
    signs = t.posts_raw.withColumns(
        {
            "content": F.concat("content", F.lit(" \U0001F35C❤️★\U0001F468‍\U0001F373end\U0001F1F0\U0001F1F71️⃣")),
            "hashtags": F.transform("hashtags", lambda x: F.concat(x, F.lit("\U0001F600"))),
        }
    )
    return ingest.clear_emoji(signs).select("ingest_seq", F.md5("content").alias("body"), F.array_join("hashtags", "|").alias("tags"))


@query(
    "post_id_from_url",
    "SELECT page_id, nullif(regexp_extract(replace(url, '.com/', '.com/p/'), '/p/([^/?#]+)/', 1), '') AS post_id FROM pages",
)
def post_id_from_url(t):
    return t["pages"].select("page_id", text.post_id_from_url(F.replace("url", F.lit(".com/"), F.lit(".com/p/"))).alias("post_id"))


@query(
    "handle_from_href",
    """SELECT page_id, CASE WHEN h IN ('', 'p', 'reel', 'explore', 'stories') THEN NULL ELSE h END AS handle
       FROM (SELECT page_id, lower(regexp_extract(concat(regexp_replace(url, '[?#].*$', ''), '/'), '/([^/]+)/$', 1)) AS h FROM pages)""",
)
def handle_from_href(t):
    href = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/"))
    return t["pages"].select("page_id", text.handle_from_href(href).alias("handle"))


LIKES_SQL = r"""CASE WHEN regexp_matches(likes, '\d+(?:\.\d+)?\s*[kKmM]')
    THEN CAST(trunc(CAST(regexp_extract(likes, '(\d+(?:\.\d+)?)\s*([kKmM])', 1) AS DOUBLE)
         * CASE WHEN lower(regexp_extract(likes, '(\d+(?:\.\d+)?)\s*([kKmM])', 2)) = 'k' THEN 1000 ELSE 1000000 END) AS BIGINT)
    WHEN regexp_matches(likes, '\d+(?:\.\d+)?\s*(천|만)')
    THEN CAST(trunc(CAST(regexp_extract(likes, '(\d+(?:\.\d+)?)\s*(천|만)', 1) AS DOUBLE)
         * CASE WHEN regexp_extract(likes, '(\d+(?:\.\d+)?)\s*(천|만)', 2) = '천' THEN 1000 ELSE 10000 END) AS BIGINT)
    WHEN regexp_matches(likes, '\d') THEN CAST(replace(regexp_extract(likes, '(\d{1,3}(?:,\d{3})+|\d+)', 1), ',', '') AS BIGINT) END"""


@query("parse_like_count", f"SELECT ingest_seq, {LIKES_SQL} AS likes_n FROM posts", POSTS)
def parse_like_count(t):
    return t.posts.select("ingest_seq", text.parse_like_count(F.col("likes")).alias("likes_n"))


@query(
    "estimate_likes",
    r"""SELECT ingest_seq, coalesce(likes_n, n_comments * 5 + n_tags * 2 + jitter) AS likes_n FROM (
        SELECT ingest_seq, """ + LIKES_SQL + r""" AS likes_n,
          CASE ingest_seq % 4 WHEN 0 THEN 3 WHEN 3 THEN 1 ELSE 0 END AS n_comments,
          length(regexp_extract_all(content, '#[^\s#,\\]+')) AS n_tags,
          CAST(concat('0x', substr(md5(coalesce(post_id, '')), 1, 6)) AS BIGINT) % 10 + 1 AS jitter FROM posts)""",
    POSTS,
)
def estimate_likes(t):
    guess = text.estimate_likes(
        coerce.comment_count_text(F.col("comments_text")), F.size(text.hashtags_strict(F.col("content"))), F.col("post_id")
    )
    return t.posts.select("ingest_seq", F.coalesce(text.parse_like_count(F.col("likes")), guess).alias("likes_n"))


MASKED_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content,
    '#\S+', ' ', 'g'),
    '광고|유료광고|협찬|제품제공|제공받|원고료|서포터즈|앰배서더|sponsored|paid partnership|gifted|AD|PPL|PR', ' ', 'gi'),
    '예약|문의|상담|구매|구매링크|디엠|DM|카톡|카카오톡|전화|프로필 링크|링크', ' ', 'gi'),
    'https?://\S+|linktr\.ee|smartstore|naver\.me|bit\.ly|pf\.kakao\.com', ' ', 'gi'),
    '(^|[^0-9])01[016789][-\s.]?\d{3,4}[-\s.]?\d{4}($|[^0-9])', '\1 \2', 'g'),
    '\s+', ' ', 'g'))"""


@query("mask_rule_signals", f"SELECT ingest_seq, md5({MASKED_SQL}) AS masked FROM posts", POSTS)
def mask_rule_signals(t):
    return t.posts.select("ingest_seq", F.md5(features.mask_rule_signals(F.col("content"))).alias("masked"))


@query(
    "extract_road_address",
    f"SELECT ingest_seq, coalesce(nullif(regexp_extract(address, '{ROAD}'), ''), trim(coalesce(address, ''))) AS road FROM posts",
    POSTS,
)
def extract_road_address(t):
    return t.posts.select("ingest_seq", text.extract_road_address(F.col("address")).alias("road"))


@query(
    "norm_name",
    r"SELECT ingest_seq, lower(regexp_replace(restaurant, '\s+', '', 'g')) AS name FROM posts", POSTS,
)
def norm_name(t):
    return t.posts.select("ingest_seq", text.norm_name(F.col("restaurant")).alias("name"))


@query(
    "name_contains",
    r"""SELECT ingest_seq, restaurant <> '' AND contains(lower(regexp_replace(content, '\s+', '', 'g')), lower(regexp_replace(restaurant, '\s+', '', 'g'))) AS in_text,
        restaurant <> '' AND contains('customer#' || lpad(cast((ingest_seq * 7) % 2000 AS string), 9, '0') || '본점', lower(regexp_replace(restaurant, '\s+', '', 'g'))) AS in_name FROM posts""",
    POSTS,
)
def name_contains(t):
    full = F.expr("concat('Customer#', lpad(cast((ingest_seq * 7) % 2000 AS string), 9, '0'), ' 본점')")
    asked = F.col("restaurant")
    return t.posts.select(
        "ingest_seq", text.name_contains(asked, F.col("content")).alias("in_text"), text.name_contains(asked, full).alias("in_name")
    )


LISTS = "CASE ingest_seq % 7 WHEN 0 THEN hashtags_json WHEN 1 THEN 'nan' WHEN 2 THEN '[bad' WHEN 3 THEN '[bad]' WHEN 4 THEN '{\"a\":1}' WHEN 5 THEN ' plain ' ELSE '[\"a\",\"b\"]' END"


@query(
    "to_list",
    f"""SELECT ingest_seq, array_to_string(CASE WHEN s IS NULL OR lower(s) IN ('', 'nan', 'none', 'null') THEN []
        WHEN s LIKE '[%]' THEN coalesce(CASE WHEN json_valid(s) THEN CAST(from_json(s, '["VARCHAR"]') AS VARCHAR[]) END, [])
        WHEN s LIKE '{{%}}' THEN [] ELSE [s] END, '|') AS items FROM (SELECT ingest_seq, trim({LISTS}) AS s FROM posts)""",
    POSTS,
)
def to_list(t):
    return t.posts.select("ingest_seq", F.array_join(coerce.to_list(F.expr(LISTS)), "|").alias("items"))


JSONS = "CASE ingest_seq % 4 WHEN 0 THEN hashtags_json WHEN 1 THEN '[bad]' WHEN 2 THEN concat('{\"n\": ', cast(ingest_seq AS string), ' }') ELSE search_tag END"


@query(
    "parse_json_like",
    f"SELECT ingest_seq, CASE WHEN (s LIKE '[%]' OR s LIKE '{{%}}') AND json_valid(s) THEN CAST(json(s) AS VARCHAR) ELSE s END AS parsed FROM (SELECT ingest_seq, {JSONS} AS s FROM posts)",
    POSTS,
)
def parse_json_like(t):
    return t.posts.select("ingest_seq", coerce.parse_json_like(F.expr(JSONS)).alias("parsed"))


INTS = "CASE ingest_seq % 3 WHEN 0 THEN concat(cast(ingest_seq AS string), '.7') WHEN 1 THEN concat('1,', lpad(cast(ingest_seq % 1000 AS string), 3, '0')) ELSE likes END"


@query(
    "to_int",
    f"SELECT ingest_seq, coalesce(CAST(trunc(try_cast(replace({INTS}, ',', '') AS DOUBLE)) AS BIGINT), 0) AS n FROM posts", POSTS,
)
def to_int(t):
    return t.posts.select("ingest_seq", coerce.to_int(F.expr(INTS)).alias("n"))


@query("parse_dt", "SELECT ingest_seq, strftime(try_cast(date AS TIMESTAMP), '%Y-%m-%d %H:%M') AS at FROM posts", POSTS)
def parse_dt(t):
    return t.posts.select("ingest_seq", F.date_format(coerce.parse_dt(F.col("date")), "yyyy-MM-dd HH:mm").alias("at"))


@query(
    "comment_count",
    r"""SELECT ingest_seq, length(list_filter(string_split_regex(coalesce(comments_text, ''), '[\n,]+'), lambda x: trim(x) <> '')) AS n,
        length(list_filter(string_split_regex(content, '[\n,]+'), lambda x: trim(x) <> '')) AS n_text FROM posts""",
    POSTS,
)
def comment_count(t):
    return t.posts.select(
        "ingest_seq", coerce.comment_count(F.col("comments_text"), "string").cast("bigint").alias("n"),
        coerce.comment_count(F.col("content"), "string").cast("bigint").alias("n_text"),
    )


@query("sha1_16", "SELECT ingest_seq, substr(sha1(content), 1, 16) AS h FROM posts", POSTS)
def sha1_16(t):
    return t.posts.select("ingest_seq", text.sha1_16(F.col("content")).alias("h"))


@query("log1p_feature", "SELECT ingest_seq, round(ln(1 + coalesce(try_cast(likes AS DOUBLE), 0)), 9) AS x FROM posts", POSTS)
def log1p_feature(t):
    return t.posts.select("ingest_seq", F.round(coerce.log1p_feature(F.col("likes")), 9).alias("x"))


@query(
    "pick_content_col", "SELECT doc_id, md5(text) AS body FROM documents",
)
def pick_content_col_query(t):
    docs = t["documents"]
    return docs.withColumnRenamed(pick_content_col(docs), "content").select("doc_id", F.md5("content").alias("body"))


@query("conform", "SELECT ingest_seq, restaurant AS restaurant_name, '' AS address FROM posts", POSTS)
def conform_query(t):
    loose = t.posts.select("ingest_seq", "content", F.col("restaurant").alias("restaurant name"))
    return conform(loose, ("content", "restaurant_name")).select("ingest_seq", "restaurant_name", "address")


@query(
    "normalize_posts",
    """SELECT ingest_seq, coalesce(array_to_string(CAST(from_json(hashtags_json, '["VARCHAR"]') AS VARCHAR[]), '|'), '') AS tags,
       coalesce(CAST(trunc(try_cast(replace(likes, ',', '') AS DOUBLE)) AS BIGINT), 0) AS likes,
       CASE ingest_seq % 4 WHEN 0 THEN 3 WHEN 3 THEN 1 ELSE 0 END AS comment_count,
       strftime(try_cast(date AS TIMESTAMP), '%Y-%m-%d') AS created, coalesce(toxic, 0) AS is_ad
       FROM posts LEFT JOIN labels ON ingest_seq = doc_id""",
    POSTS,
)
def normalize_posts(t):
    loose = t.posts.select(
        "ingest_seq", F.col("hashtags_json").alias("hashtags"), "likes", F.col("comments_text").alias("comments"), "date"
    ).join(t["labels"].select(F.col("doc_id").alias("ingest_seq"), F.col("toxic").alias("is_ad")), "ingest_seq", "left")
    return ingest.normalize_posts(loose).select(
        "ingest_seq", F.array_join("hashtags", "|").alias("tags"), "likes", "comment_count",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"), "is_ad",
    )


@query(
    "drop_blank_content",
    f"SELECT ingest_seq, md5(c) AS body FROM (SELECT ingest_seq, {STRIPPED('c0')} AS c FROM (SELECT ingest_seq, CASE ingest_seq % 9 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE ' ' || content || chr(10) END AS c0 FROM posts)) WHERE c <> ''",
    POSTS,
)
def drop_blank_content(t):
    loose = t.posts.withColumn("content", F.expr("CASE ingest_seq % 9 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE concat(' ', content, chr(10)) END"))
    return ingest.drop_blank_content(loose).select("ingest_seq", F.md5("content").alias("body"))


@query("label_to_int", "SELECT ingest_seq, coalesce(toxic, 0) AS is_ad FROM posts LEFT JOIN labels ON ingest_seq = doc_id", POSTS)
def label_to_int(t):
    marks = t["labels"].select(F.col("doc_id").alias("ingest_seq"), F.col("toxic").cast("string").alias("is_ad"))
    return t.posts.join(marks, "ingest_seq", "left").select("ingest_seq", coerce.label_to_int(F.col("is_ad")).alias("is_ad"))


@query(
    "enrichment_key",
    """SELECT ingest_seq, CASE WHEN coalesce(trim(post_id), '') <> '' THEN concat('id:', trim(post_id)) ELSE concat('c:', substr(sha1(content), 1, 16)) END AS key,
       CASE WHEN coalesce(trim(post_id), '') <> '' THEN '' ELSE substr(sha1(content), 1, 16) END AS content_hash FROM posts""",
    POSTS,
)
def enrichment_key(t):
    return enrich.with_key(t.posts).select("ingest_seq", "key", "content_hash")


@query(
    "extracted_row",
    """SELECT ingest_seq, CASE WHEN trim(restaurant) <> '' THEN concat('["', restaurant, '"]') ELSE '[]' END AS names,
       CASE WHEN trim(coalesce(address, '')) <> '' THEN concat('["', address, '"]') ELSE '[]' END AS addresses FROM posts""",
    POSTS,
)
def extracted_row(t):
    return t.posts.select(
        "ingest_seq", F.to_json(coerce.wrap(F.col("restaurant"))).alias("names"), F.to_json(coerce.wrap(F.col("address"))).alias("addresses")
    )


ADDRESS_FORMS = "CASE ingest_seq % 4 WHEN 0 THEN address WHEN 1 THEN concat('[\"', search_tag, '\", \"x\"]') WHEN 2 THEN '[]' ELSE concat(' ', search_tag, ' ') END"


@query(
    "coerce_first_address",
    "SELECT ingest_seq, CASE ingest_seq % 4 WHEN 1 THEN search_tag WHEN 3 THEN search_tag ELSE '' END AS address FROM posts", POSTS,
)
def coerce_first_address(t):
    return t.posts.select("ingest_seq", coerce.first_address(F.expr(ADDRESS_FORMS)).alias("address"))


@query("coalesce_name", "SELECT ingest_seq, trim(restaurant) AS name FROM posts", POSTS)
def coalesce_name(t):
    listed = t.posts.select("ingest_seq", coerce.wrap(F.concat(F.lit(" "), "restaurant")).alias("restaurant name"))
    return places.lookup_columns(listed).select("ingest_seq", F.col("query_name").alias("name"))


@query(
    "skip_no_address",
    "SELECT count(*) AS posts, count(*) FILTER (address IS NULL) AS skipped, count(DISTINCT address) AS addresses FROM posts", POSTS,
)
def skip_no_address(t):
    asked = places.lookup_columns(t.posts.withColumnRenamed("restaurant", "restaurant_name"))
    return asked.agg(
        F.count(F.lit(1)).alias("posts"), F.count_if(F.col("road_address") == "").alias("skipped"),
        F.count_distinct(F.nullif("road_address", F.lit(""))).alias("addresses"),
    )


@query("build_prompt", "SELECT ingest_seq, md5(concat('A ', content, ' Z')) AS prompt FROM posts", POSTS)
def build_prompt(t):
    return t.posts.select("ingest_seq", F.md5(answers.build_prompt(F.col("content"), "A {content} Z")).alias("prompt"))


@query("outer_json", r"SELECT ingest_seq, nullif(regexp_extract(response, '(?s)\{.*\}'), '') AS body FROM posts", POSTS)
def outer_json(t):
    return t.posts.select("ingest_seq", answers.outer_json(F.col("response")).alias("body"))


JUDGED_SQL = r"""judged AS (SELECT *, CASE WHEN regexp_matches(j ->> '$.place_count', '^[0-9]+$') THEN CAST(j ->> '$.place_count' AS INT) ELSE 0 END AS place_count,
    len(list_filter(CAST(coalesce(json_extract(j, '$.places[*]'), []) AS JSON[]), lambda p: json_type(p) = 'OBJECT')) AS n_places,
    trim(coalesce(list_filter(CAST(coalesce(json_extract(j, '$.places[*]'), []) AS JSON[]), lambda p: json_type(p) = 'OBJECT')[1] ->> '$.restaurant_name', '')) AS name,
    least(1.0e0, greatest(0.0e0, coalesce(try_cast(j ->> '$.confidence' AS DOUBLE), 0.0e0))) AS confidence
    FROM (SELECT *, CASE WHEN json_valid(regexp_extract(response, '(?s)\{.*\}')) THEN CAST(regexp_extract(response, '(?s)\{.*\}') AS JSON) END AS j FROM posts))"""


@query(
    "validate_answer",
    "SELECT ingest_seq, place_count, n_places, CASE WHEN n_places > 0 THEN name END AS name, confidence FROM judged", POSTS, JUDGED_SQL,
)
def validate_answer(t):
    return t.posts.withColumn("a", answers.validate_answer(F.col("response"))).select(
        "ingest_seq", "a.place_count", F.size("a.places").cast("bigint").alias("n_places"),
        F.get("a.places", 0)["restaurant_name"].alias("name"), "a.confidence",
    )


@query(
    "single_place_gate",
    "SELECT ingest_seq, place_count = 1 AND n_places > 0 AS accepted, CASE WHEN place_count = 1 AND n_places > 0 THEN name END AS name FROM judged",
    POSTS, JUDGED_SQL,
)
def single_place_gate(t):
    judged = enrich.with_place(t.posts)
    return judged.select("ingest_seq", F.col("place").isNotNull().alias("accepted"), F.col("place.restaurant_name").alias("name"))
