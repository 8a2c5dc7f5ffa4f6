import pytest
from pyspark.sql import functions as F

from postsieve.operators import enrich
from postsieve.operators.dedupe import dedupe_keep_last
from postsieve.plans import jobs
from postsieve.schemas import EXTRACT_FAILURES, EXTRACTED, LLM_RESPONSE, POSTS_RAW
from postsieve.sources import store

GOOD = '{"place_count":1,"places":[{"restaurant_name":"여수식당","address":"a"}],"is_ad":true,"confidence":0.9}'
BLANK = '{"place_count":1,"places":[{"restaurant_name":""}]}'
BAD = '{"place_count":2,"places":[{},{}]}'


def post(seq, pid, content, tag="t"):
    return (pid, content, "1", None, None, "", tag, seq)


@pytest.fixture
def state(spark, tmp_path):
    posts = spark.createDataFrame(
        [post(1, "A", "one"), post(2, "B", "two"), post(3, None, "abc"), post(4, "D", " one "), post(5, "E", " "), post(6, "F", None), post(7, "G", "seven")],
        POSTS_RAW,
    )
    answers = spark.createDataFrame([("id:D", GOOD), ("id:B", BAD), ("c:a9993e364706816a", BLANK)], LLM_RESPONSE)
    return posts, answers, str(tmp_path / "extracted"), str(tmp_path / "failures")


def read(spark, state):
    return store.read_table(spark, state[2]), store.read_table(spark, state[3])


def test_key(spark):
    keys = enrich.with_key(spark.createDataFrame([("A", "x"), (None, "abc"), (" ", "abc")], "post_id string, content string"))
    assert [(r["key"], r["content_hash"]) for r in keys.collect()] == [("id:A", ""), *[("c:a9993e364706816a", "a9993e364706816a")] * 2]


def test_run_twice_adds_nothing(spark, state):
    jobs.enrich_posts(spark, *state)
    ok, bad = read(spark, state)
    first = sorted((r["content"], r["restaurant_name"], r["address"], r["post_id"]) for r in ok.select("content", "restaurant_name", "address", F.coalesce("post_id", F.lit("")).alias("post_id")).collect())
    assert first == [("abc", [], [], ""), ("one", ["여수식당"], ["a"], "D")]
    assert sorted((r["key"], r["attempts"], r["sample_tag"]) for r in bad.collect()) == [("id:B", 1, "t"), ("id:G", 1, "t")]
    jobs.enrich_posts(spark, *state)
    ok2, bad2 = read(spark, state)
    assert ok2.count() == 2 and sorted(r["attempts"] for r in bad2.collect()) == [1, 1]
    assert enrich.seen_keys(ok2).join(bad2, "key", "left_semi").count() == 0


def test_retry_counts_and_clears(spark, state):
    posts, answers, *roots = state
    jobs.enrich_posts(spark, *state)
    later = answers.where("key <> 'id:B'").unionByName(spark.createDataFrame([("id:B", GOOD)], LLM_RESPONSE))
    jobs.enrich_posts(spark, posts, later, *roots, retry_failed=True)
    ok, bad = read(spark, state)
    assert ok.count() == 3 and [(r["key"], r["attempts"]) for r in bad.collect()] == [("id:G", 2)]


def test_one_key_with_both_outcomes_stays_failed(spark):
    old = spark.createDataFrame([("id:A", "A", "", 4, None, "x")], EXTRACT_FAILURES)
    rows = spark.createDataFrame([(1, "A", "c1", "t1", GOOD), (2, "A", "c2", "t2", BAD)], "ingest_seq long, post_id string, content string, search_tag string, response string")
    merged = enrich.merge_fail_log(old, enrich.with_place(enrich.with_key(rows)), F.current_timestamp())
    assert [(r["key"], r["attempts"], r["sample_tag"]) for r in merged.collect()] == [("id:A", 5, "t2")]


def test_empty_state_keeps_its_schema(spark, tmp_path):
    store.write_version(spark.createDataFrame([], EXTRACT_FAILURES), str(tmp_path))
    back = store.read_table(spark, str(tmp_path))
    assert back.columns == EXTRACT_FAILURES.names and back.count() == 0
    assert store.read_table(spark, str(tmp_path / "none"), EXTRACTED).count() == 0


def test_old_results_give_way_to_new(spark):
    old = spark.createDataFrame([("one", 9)], "content string, ingest_seq long")
    new = spark.createDataFrame([("one", 3), ("two", 4)], "content string, ingest_seq long")
    assert sorted(tuple(r) for r in enrich.merge_extracted(old, new).collect()) == [("one", 3), ("two", 4)]
    assert dedupe_keep_last(old, ["content"]).count() == 1


def shuffles(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def test_texts_are_compared_by_hash_and_moved_once(spark, state):
    """pending rows come in after they are known, and results are merged without their texts in the key."""
    posts, _, *roots = state
    extracted = store.read_table(spark, roots[0], EXTRACTED)
    pending = enrich.pending_posts(posts, extracted, store.read_table(spark, roots[1], EXTRACT_FAILURES))
    assert len(shuffles(pending)) == 1
    assert sorted(r["key"] for r in pending.collect()) == ["c:a9993e364706816a", "id:B", "id:D", "id:G"]
    old = spark.createDataFrame([("one", 9), (None, 1), (None, 2)], "content string, ingest_seq long")
    merged = enrich.merge_extracted(old, old.where("ingest_seq = 9"))
    assert len(shuffles(merged)) == 1 and "content#" not in shuffles(merged)[0]
    assert sorted(r["ingest_seq"] for r in merged.collect()) == [2, 9]
