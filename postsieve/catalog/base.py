"""Registry of checkable queries and the input frames they share.

A query is a function of ``Tables``; its SQL twin runs on another engine over the same Parquet files. Posts are
derived from ``documents`` (see FIXTURES.md): column expressions that both engines read, whole texts, all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The phrases of the golden rule rows, with their form after NFKC where that differs.
PHRASES = [
    "오늘 점심 맛있었다", "#광고 여수 맛집", "#광고, 여수", "맛있다 협찬", "광.고 아님", "광...고", "할인 이벤트",
    "구매 하세요", "예약 010-1234-5678", "https://bit.ly/x", "smart.com 방문", "admin 페이지", "AD입니다",
    "ＡＤ 포함", "유​료 광 고", "맛있다", "01012345678901", "링크 https://a.b 010-1234-5678",
    "#광고 구매링크 https://x 010-1234-5678", "salad 추천", "링크 https://a.b", "#광고#협찬",
]
NORMAL_FORM = {"ＡＤ 포함": "AD 포함", "유​료 광 고": "유료 광 고"}

# Recorded answers of every kind the validation tells apart.
ANSWERS = [
    'ok {"place_count":1,"places":[{"restaurant_name":" x ","address":null}],"confidence":1.7} end',
    '{"place_count":"1","places":[3,{"restaurant_name":7}]}',
    '{"place_count":1,"places":[{"restaurant_name":""}]}',
    '{"place_count":2,"places":[{},{}]}',
    '{"place_count":"1.0","places":[{}]}',
    '{"place_count":1,"places":[]}',
    "not json",
    None,
]


def case_of(key: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} % {len(values)} {arms} END"


def post_columns(phrases: list[str]) -> dict[str, str]:
    """Column expressions over ``documents``, in SQL that Spark and DuckDB both read."""
    text = "cast({} AS string)".format
    return {
        "ingest_seq": "doc_id",
        "post_id": (
            f"CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 50 = 1 THEN '' "
            f"WHEN doc_id % 10 = 9 THEN concat('p', {text('doc_id - 1')}) ELSE concat('p', {text('doc_id')}) END"
        ),
        "content": f"concat(text, ' ', {case_of('doc_id', phrases)})",
        "likes": (
            f"CASE doc_id % 6 WHEN 0 THEN '1.2k' WHEN 1 THEN '3만' WHEN 2 THEN '1,234' WHEN 3 THEN 'many' "
            f"WHEN 5 THEN {text('doc_id')} END"
        ),
        "hashtags_json": """CASE doc_id % 5 WHEN 0 THEN '["#맛집"]' WHEN 1 THEN '["#협찬"]' WHEN 2 THEN '["##AD"]' WHEN 3 THEN '[]' END""",
        "comments_text": "CASE doc_id % 4 WHEN 0 THEN concat('a, b', chr(10), 'c') WHEN 1 THEN '' WHEN 3 THEN '좋아요' END",
        "date": f"CASE doc_id % 3 WHEN 1 THEN '' WHEN 2 THEN concat('2025-08-', lpad({text('doc_id % 28 + 1')}, 2, '0')) END",
        "search_tag": "source",
        "response": case_of("doc_id", ANSWERS),
        "address": f"CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('주소: 서울 종로구 세종로 ', {text('(doc_id * 7) % 2000')}, ' 1층') END",
        "restaurant": (
            f"CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN concat('Customer#', lpad({text('(doc_id * 7) % 2000')}, 9, '0')) "
            f"WHEN 2 THEN concat('customer #', lpad({text('(doc_id * 7) % 2000')}, 9, '0'), ' 본점') "
            f"WHEN 3 THEN '#000' ELSE '없는집' END"
        ),
        "text": "text",
        "lang": "lang",
    }


def oracle_posts(name: str = "posts", phrases: list[str] | None = None) -> str:
    columns = ", ".join(f'{expr} AS "{col}"' for col, expr in post_columns(phrases or PHRASES).items())
    return f"{name} AS (SELECT {columns} FROM documents)"


PLACE_COLUMNS = {
    "place_name": "name",
    "category_group_code": "CASE k % 3 WHEN 0 THEN 'FD6' WHEN 1 THEN 'CE7' END",
    "road_address_name": "CASE WHEN k % 4 = 0 THEN NULL ELSE concat('서울 종로구 세종로 ', cast(k AS string)) END",
    "address_name": "concat('서울 종로구 ', cast(k AS string))",
    "lat": "37.5e0 + (k % 40) * 0.003e0 + (k % 7) * 0.0004e0",
    "lng": "127.0e0 + ((k - k % 40) / 40 % 40) * 0.004e0 + (k % 5) * 0.0003e0",
    "rank": "cast(k % 11 AS int)",
    "place_key": "k",
}
ADDRESS_COLUMNS = {
    "road_address": "concat('서울 종로구 세종로 ', cast(c_custkey AS string))",
    "lat": "37.5e0 + (c_custkey % 40) * 0.003e0",
    "lng": "127.0e0 + ((c_custkey - c_custkey % 40) / 40 % 40) * 0.004e0",
    "region": "concat('행정동 ', cast(c_nationkey AS string))",
}


def raw_form(posts: DataFrame) -> DataFrame:
    from postsieve.functions.coerce import to_list

    return posts.select(
        "post_id", "content", "likes", to_list(F.col("hashtags_json")).alias("hashtags"),
        to_list(F.col("comments_text")).alias("comments"), "date", "search_tag", "ingest_seq",
    )


class Tables:
    """Input frames of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def posts(self) -> DataFrame:
        """Posts with text columns as a CSV would bring them."""
        # One exchange whatever the size: a rule costs hundreds of times what moving its row does, and files need not be even.
        docs = self["documents"].repartition("doc_id")
        return docs.selectExpr(*[f"{e} AS `{c}`" for c, e in post_columns(PHRASES).items()])

    @cached_property
    def posts_unmoved(self) -> DataFrame:
        """The same posts as their files lie, for steps that cost less than moving the texts."""
        return self["documents"].selectExpr(*[f"{e} AS `{c}`" for c, e in post_columns(PHRASES).items()])

    @cached_property
    def posts_raw(self) -> DataFrame:
        """Posts in the form of the ``posts_raw`` table."""
        return raw_form(self.posts)

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled documents with a made-up score: doc_id, label, score."""
        return self["labels"].selectExpr("doc_id", "toxic AS label", "((doc_id * 37) % 101) / 100.0e0 AS score")

    @cached_property
    def addresses(self) -> DataFrame:
        return self["customer"].selectExpr(*[f"{e} AS {c}" for c, e in ADDRESS_COLUMNS.items()])

    @cached_property
    def places(self) -> DataFrame:
        named = self["customer"].repartition("c_custkey").selectExpr("c_name AS name", "c_custkey AS k").unionByName(
            self["supplier"].selectExpr("s_name AS name", "s_suppkey + 1000000 AS k")
        )
        return named.selectExpr(*[f"{e} AS {c}" for c, e in PLACE_COLUMNS.items()])


SCORED_SQL = 'scored AS (SELECT doc_id, toxic AS label, ((doc_id * 37) % 101) / 100.0e0 AS score FROM labels)'
ADDRESSES_SQL = "addresses AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in ADDRESS_COLUMNS.items()) + " FROM customer)"
PLACES_SQL = (
    "named AS (SELECT c_name AS name, c_custkey AS k FROM customer UNION ALL SELECT s_name, s_suppkey + 1000000 FROM supplier), "
    "places AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in PLACE_COLUMNS.items()) + " FROM named)"
)


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a query and, where SQL can express it, its twin with the common tables it needs."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql.strip()
        return fn

    return register


POSTS = oracle_posts()
POSTS_NFKC = oracle_posts("posts", [NORMAL_FORM.get(p, p) for p in PHRASES])
