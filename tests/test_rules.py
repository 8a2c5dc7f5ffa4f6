import pytest
from pyspark.sql import functions as F

from postsieve.operators import labels

# Golden rows: content, tags, signals, score, recall label (30), balanced label (40).
ROWS = [
    ("오늘 점심 맛있었다", [], "", 0, 0, 0), ("#광고 여수 맛집", [], "hash kw", 100, 1, 1), ("#광고, 여수", [], "kw", 30, 1, 0),
    ("맛있다", ["#협찬"], "hash", 70, 1, 1), ("광.고 아님", [], "kw", 30, 1, 0), ("광...고", [], "", 0, 0, 0),
    ("할인 이벤트", [], "kw_simple", 20, 1, 0), ("구매 하세요", [], "cta kw_simple", 30, 1, 1),
    ("예약 010-1234-5678", [], "cta phone", 20, 1, 0), ("https://bit.ly/x", [], "link", 15, 0, 0),
    ("smart.com 방문", [], "link", 15, 0, 0), ("admin 페이지", [], "cta", 10, 0, 0), ("AD입니다", [], "", 0, 0, 0),
    ("ＡＤ 포함", [], "kw", 30, 1, 0), ("유​료 광 고", [], "kw", 30, 1, 0), ("맛있다", ["##AD"], "hash", 70, 1, 1),
    ("01012345678901", [], "", 0, 0, 0), ("링크 https://a.b 010-1234-5678", [], "cta link phone", 35, 1, 0),
    ("#광고 구매링크 https://x 010-1234-5678", [], "cta hash kw link phone", 100, 1, 1), ("salad 추천", [], "", 0, 0, 0),
    ("링크 https://a.b", [], "cta link", 25, 1, 0), ("#광고#협찬", [], "kw", 30, 1, 0),
    # Beyond the list: word edges, letter gaps, blanks of other kinds, NULL.
    ("a paid  partnership!", [], "kw", 30, 1, 0), ("paid　partnership", [], "kw", 30, 1, 0), ("PR_x", [], "", 0, 0, 0),
    ("제 품 - 제 공", [], "", 0, 0, 0), ("제 품 제.공", [], "kw", 30, 1, 0), ("카카오톡 SmartStore", [], "cta link", 25, 1, 0),
    (None, None, "", 0, 0, 0), ("고 광", [], "", 0, 0, 0), ("REPOST", [], "kw", 30, 1, 0), ("reposted", [], "kw_simple", 20, 1, 0),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(ROWS)], "ingest_seq long, content string, hashtags array<string>")


def test_golden_rows(posts):
    recall = labels.apply_ad_rules(posts, thr=30, mode="recall")
    balanced = {r["ingest_seq"]: r["is_ad"] for r in labels.apply_ad_rules(posts).collect()}
    for r in recall.collect():
        content, _, signals, score, want_recall, want_balanced = ROWS[r["ingest_seq"]]
        got = " ".join(sorted(r["rule_why"]))
        assert (got, r["rule_score"], r["is_ad"], balanced[r["ingest_seq"]]) == (signals, score, want_recall, want_balanced), content


def test_threshold_decides_only_when_low(posts):
    low = {r["content"]: r["is_ad"] for r in labels.apply_ad_rules(posts, thr=30).collect()}
    assert low["광.고 아님"] == 1 and low["링크 https://a.b 010-1234-5678"] == 1


def test_text_tags_column(spark):
    rows = spark.createDataFrame([(1, "x", "see #협찬 now"), (2, "x", '["#PPL"]'), (3, "x", None)], "ingest_seq long, content string, hashtags string")
    assert [r["is_ad"] for r in labels.apply_ad_rules(rows).orderBy("ingest_seq").collect()] == [1, 1, 0]


def test_missing_columns(spark):
    only_text = spark.createDataFrame([("#광고 x",)], "content string")
    assert labels.apply_ad_rules(only_text).first()["is_ad"] == 1
    with pytest.raises(ValueError, match="missing column"):
        labels.apply_ad_rules(only_text, content_col="body")
    with pytest.raises(ValueError, match="mode"):
        labels.ad_label(30, "strict")


def test_split_and_distribution(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 0)], "id int, is_ad int")
    non_ads, ads = labels.split_by_label(rows)
    assert non_ads.count() + ads.count() == rows.where("is_ad is not null").count()
    d = labels.label_distribution(rows).first()
    assert (d["pos"], d["neg"], d["total"], d["ratio"]) == (1, 2, 4, 25.0)
    assert labels.label_distribution(rows.where("false")).first()["ratio"] == 0.0
    assert labels.filter_nonads(rows.select("id")).count() == 4 and labels.filter_nonads(rows, False).count() == 4


def test_one_python_step_and_no_shuffle(posts):
    plan = labels.apply_ad_rules(posts.withColumn("content", F.concat("content", F.lit(" ")))).where("rule_score > 0")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "Exchange" not in text


def test_other_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("#광고", "a")], "content string, search_tag string").write.parquet(str(tmp_path / "p"))
    df = labels.apply_ad_rules(spark.read.parquet(str(tmp_path / "p"))).where("search_tag = 'a' and is_ad = 1")
    assert "EqualTo(search_tag,a)" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 1
