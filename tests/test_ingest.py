import random

import pytest
from pyspark.sql import functions as F

from postsieve.operators import dedupe, ingest
from postsieve.schemas import POSTS_RAW, conform, pick_content_col
from postsieve.streaming import ingest as stream

SCHEMA = "ingest_seq long, post_id string, content string, date string"


def rows(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_fill_date_golden(spark, chunk):
    posts = spark.createDataFrame([(i, "p", "c", d) for i, d in enumerate(["", "d1", None, "d2", ""])], SCHEMA)
    got = ingest.fill_date(posts, chunk_rows=chunk).orderBy("ingest_seq")
    assert [r["date"] for r in got.collect()] == ["d1", "d1", "d1", "d2", "d2"]


def brute_fill(data):
    out = []
    for seq, pid, _, date in data:
        if date and date.strip():
            out.append((seq, date))
            continue
        same = [(s, d) for s, p, _, d in data if p and p.strip() and p == pid and d and d.strip()]
        before = [d for s, d in same if s < seq]
        after = [d for s, d in same if s > seq]
        out.append((seq, before[-1] if before else after[0] if after else (date or "")))
    return sorted(out)


def hot_posts(n=400):
    """A third of the rows have one id, some have none."""
    rng = random.Random(7)
    return [
        (i, rng.choice(["hot", "hot", None, "", *[f"p{j}" for j in range(3)]]), f"c{rng.randrange(5)}", rng.choice([None, "", f"d{i}"]))
        for i in range(n)
    ]


def test_fill_date_brute_force(spark):
    data = hot_posts()
    got = ingest.fill_date(spark.createDataFrame(data, SCHEMA), chunk_rows=9)
    assert sorted((r["ingest_seq"], r["date"]) for r in got.collect()) == brute_fill(data)


def test_resolve_is_fill_then_dedupe(spark):
    posts = spark.createDataFrame(hot_posts(), SCHEMA)
    slow = dedupe.dedupe_posts(ingest.fill_date(posts, 50))
    fast = ingest.resolve_posts(posts)
    cols = ["ingest_seq", "post_id", "content", "date"]
    assert rows(fast, *cols) == rows(slow, *cols)
    assert rows(ingest.resolve_posts(fast), *cols) == rows(fast, *cols)


def test_keep_last_and_missing_ids(spark):
    posts = spark.createDataFrame([(1, "A", "1", ""), (2, "B", "2", ""), (3, "A", "3", "")], SCHEMA)
    assert rows(dedupe.dedupe_posts(posts), "post_id", "content") == [("A", "3"), ("B", "2")]
    no_id = spark.createDataFrame([(1, None, "x", "d1"), (2, None, "x", "d2"), (3, "", "x", "d2")], SCHEMA)
    assert rows(dedupe.dedupe_posts(no_id), "ingest_seq") == [(1,), (3,)]


def test_dedupe_cuts_before_the_shuffle(spark):
    plan = dedupe.dedupe_keep_last(spark.range(100).selectExpr("id % 3 as k", "id as ingest_seq"), ["k"])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_anti_seen(spark):
    new = spark.createDataFrame([(1, "A", "", ""), (2, "B", "", ""), (3, None, "", ""), (4, " ", "", "")], SCHEMA)
    seen = spark.createDataFrame([("A",), (None,), ("",)], "post_id string")
    assert rows(ingest.anti_seen_posts(new, seen), "ingest_seq") == [(2,), (3,), (4,)]


def test_sort(spark):
    posts = spark.createDataFrame([(1, "a", "", "2025-08-02"), (2, "b", "", "bad"), (3, "c", "", "2025-08-05")], SCHEMA)
    assert [r["ingest_seq"] for r in ingest.sort_by_date_desc(posts).collect()] == [3, 1, 2]


def test_duplicates(spark):
    posts = spark.createDataFrame([(1, "a", "x", ""), (2, "b", "x", ""), (3, "c", "y", ""), (4, "d", None, ""), (5, "e", None, "")], SCHEMA)
    assert rows(dedupe.key_counts(posts, "content"), "content", "cnt", "keep_seq") == sorted([("x", 2, 1), (None, 2, 4)], key=repr)
    assert rows(dedupe.duplicate_rows(posts, "content"), "ingest_seq") == [(2,), (5,)]
    assert dedupe.assert_unique_key(posts, "post_id").count() == 0


def test_clean_posts(spark):
    raw = spark.createDataFrame([("foodie", "foodie 맛집🍜 #여수,#맛집 3시간 전", ["굿👍"])], "username string, content string, comments array<string>")
    row = ingest.clean_posts(raw).first()
    assert (row["content"], row["hashtags"], row["comments"]) == ("맛집 #여수,#맛집", ["#여수", "#맛집"], ["굿"])


def test_normalize_and_serialize(spark):
    raw = spark.createDataFrame([("['#광고']", "1,200", "a,b", "2025-08-01", None)], "hashtags string, likes string, comments string, date string, is_ad double")
    row = ingest.normalize_posts(raw).first()
    assert (row["hashtags"], row["likes"], row["comment_count"], row["is_ad"]) == (["#광고"], 1200, 2, 0)
    listed = spark.createDataFrame([(["맛집"], "t"), (None, None)], "hashtags array<string>, comments string")
    assert rows(ingest.serialize_lists(listed), "hashtags", "comments") == [("", ""), ('["맛집"]', "t")]


def test_conform(spark):
    df = spark.createDataFrame([("x", "y")], "`restaurant name` string, caption string")
    assert conform(df).columns == ["restaurant_name", "caption", "address"] and pick_content_col(df) == "caption"
    with pytest.raises(ValueError):
        conform(df, ("is_ad",))


def test_stream_equals_batch(spark, tmp_path):
    data = [(p, c, None, None, None, d, None, s) for s, p, c, d in hot_posts(120)]
    posts = spark.createDataFrame(data, POSTS_RAW)
    root = str(tmp_path)
    for lo, hi in ((0, 40), (40, 80), (80, 120)):
        posts.where((F.col("ingest_seq") >= lo) & (F.col("ingest_seq") < hi)).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        stream.ingest_stream(spark, f"{root}/landing", root, f"{root}/cp").awaitTermination()
        if hi == 80:
            stream.compact(spark, root, upto=0)
    cols = ["ingest_seq", "post_id", "content", "date"]
    want = rows(ingest.resolve_posts(posts), *cols)
    assert rows(stream.read_posts(spark, root), *cols) == want
    # A replayed batch overwrites itself; compaction up to the last batch changes nothing.
    stream.write_batch(posts.where("ingest_seq >= 80"), 2, root)
    stream.compact(spark, root, upto=2)
    assert rows(stream.read_posts(spark, root), *cols) == want


def test_arrival_order_grows_with_batches(spark, tmp_path):
    """Rows that bring no number: the later batch wins, and inside a batch the later row."""
    for batch, texts in enumerate((["a", "b"], ["c", "d"])):
        rows = spark.createDataFrame([("p", t, "") for t in texts], "post_id string, content string, date string").coalesce(1)
        stream.write_batch(rows, batch, str(tmp_path))
    seqs = {r["content"]: r["ingest_seq"] for r in spark.read.parquet(f"{tmp_path}/log").collect()}
    assert set(seqs) == {"b", "d"} and seqs["b"] < seqs["d"]
