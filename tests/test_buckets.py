"""Tables in buckets: what a load touches, and that it equals a merge of whole tables."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postsieve.operators import publish
from postsieve.plans import jobs
from postsieve.sources import buckets, store


def rows(spark, n, text, start=0):
    return spark.range(start, start + n).select(F.concat(F.lit("p"), "id").alias("post_id"), F.lit(text).alias("content"), F.col("id").alias("ingest_seq"))


def files(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in Path(root).rglob("*.parquet")}


def bucket(path):
    return path.split("_bucket=")[1].split("/")[0]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "t")
    first = buckets.upsert(spark, rows(spark, 2000, "old"), root, "post_id", rows_per_bucket=100)
    assert (first.before, first.after, first.buckets, first.touched) == (0, 2000, 20, 20)
    before = files(root)
    done = buckets.upsert(spark, rows(spark, 3, "new", start=1999), root, "post_id", rows_per_bucket=100)
    after = files(root)
    assert (done.before, done.after, done.buckets) == (2000, 2002, 20) and 1 <= done.touched <= 3
    changed = {bucket(f) for f in before if f not in after} | {bucket(f) for f in after if f not in before}
    assert len(changed) == done.touched
    assert all(after[f] == at for f, at in before.items() if bucket(f) not in changed)
    assert store.read_table(spark, root).where("content = 'new'").count() == 3 and store.read_table(spark, root).count() == 2002


def test_loads_equal_a_merge_of_whole_tables(spark, tmp_path):
    root, plain = str(tmp_path / "t"), None
    for step, (n, start) in enumerate([(300, 0), (50, 290), (1000, 100), (1, 5)]):
        source = rows(spark, n, f"step {step}", start).unionByName(rows(spark, 1, "no key").withColumn("post_id", F.lit(" ")))
        done = buckets.upsert(spark, source, root, "post_id", rows_per_bucket=64)
        whole = publish.merge_upsert(plain if plain is not None else source.limit(0), source, "post_id")
        plain = spark.createDataFrame(whole.collect(), source.schema)
        assert sorted(store.read_table(spark, root).collect()) == sorted(plain.collect())
        assert done.after == plain.count()
    assert buckets.buckets_in(spark, root) > 5  # laid out again while it grew


def test_only_the_touched_buckets_are_scanned(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.upsert(spark, rows(spark, 1000, "old"), root, "post_id", rows_per_bucket=100)
    some = store.read_table(spark, root, buckets=[1, 4])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {bucket(r[0]) for r in some.select(F.input_file_name()).distinct().collect()} == {"1", "4"}


def test_new_columns_and_older_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    store.write_version(rows(spark, 10, "before"), root)  # a table that is not in buckets
    buckets.upsert(spark, rows(spark, 2, "now", start=9), root, "post_id")
    more = rows(spark, 1, "more").withColumn("mark", F.lit(7))
    done = buckets.upsert(spark, more, root, "post_id")
    found = {r["post_id"]: r for r in store.read_table(spark, root).collect()}
    assert (done.before, done.after) == (11, 11) and found["p0"]["mark"] == 7 and found["p9"]["content"] == "now" and found["p9"]["mark"] is None


def test_nothing_to_merge(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.upsert(spark, rows(spark, 5, "x"), root, "post_id")
    done = buckets.upsert(spark, rows(spark, 3, "x").withColumn("post_id", F.lit(None).cast("string")), root, "post_id")
    assert (done.before, done.after, done.touched) == (5, 5, 0)


def test_a_lost_load_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.upsert(spark, rows(spark, 500, "old"), root, "post_id", rows_per_bucket=50)
    broken = rows(spark, 200, "new").withColumn("content", F.when(F.col("ingest_seq") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        buckets.upsert(spark, broken, root, "post_id", rows_per_bucket=50)
    assert store.read_table(spark, root).where("content = 'old'").count() == 500 == store.read_table(spark, root).count()


def test_load_reports(spark, tmp_path):
    report = jobs.load_target(spark, rows(spark, 20, "a"), str(tmp_path / "posts"))
    assert tuple(report.first()) == ("posts", 0, 20, 20)
    report = jobs.load_target(spark, rows(spark, 20, "a", start=10), str(tmp_path / "posts"))
    assert tuple(report.first()) == ("posts", 20, 30, 10)
    report = jobs.load_target(spark, rows(spark, 1, "b"), str(tmp_path / "posts"), dedupe_content=True)
    assert tuple(report.first()) == ("posts", 30, 2, -28)
    report = jobs.load_target(spark, rows(spark, 1, "c", start=50), str(tmp_path / "posts"))
    assert tuple(report.first()) == ("posts", 2, 3, 1)


def odd_rows(spark, rng, n, extra, with_seq=True):
    """Few keys, so that they repeat, some missing or blank; a map, which can neither be sorted nor hashed."""
    keys = [None, "", " ", *[f"p{i}" for i in range(40)]]
    found = [(rng.choice(keys), rng.choice([None, "a", "b"]), {"m": rng.randint(0, 3)}, rng.randint(0, 9), i if rng.random() < 0.9 else None) for i in range(n)]
    df = spark.createDataFrame(found, f"post_id string, content string, why map<string,int>, {extra} int, ingest_seq long")
    # Of rows with one key and no order any may be taken, so they are made equal.
    return df if with_seq else df.drop("ingest_seq").withColumns({"content": F.lower("post_id"), "why": F.create_map(F.lit("m"), F.length("post_id")), extra: F.length("post_id")})


@pytest.mark.parametrize("with_seq", [True, False])
def test_dealt_merge_equals_the_join(spark, with_seq):
    rng = random.Random(5)
    for _ in range(3):
        target = odd_rows(spark, rng, 60, "x")
        source = odd_rows(spark, rng, 80, "y", with_seq).where("ingest_seq IS NOT NULL" if with_seq else "true")
        sides = [publish.merge_upsert(target, source, "post_id", mark_new="_new", dealt_by=by) for by in (None, buckets._dealt_by(3))]
        assert sides[0].columns == sides[1].columns
        assert sorted(map(repr, sides[0].collect())) == sorted(map(repr, sides[1].collect()))


def test_a_load_moves_rows_once(spark, tmp_path):
    root = str(tmp_path / "t")
    buckets.upsert(spark, rows(spark, 500, "old"), root, "post_id")
    new = rows(spark, 500, "new", start=100)
    _, numbers, last = buckets._keys_of(new, "post_id", 1, buckets.HOT)
    merged = buckets._merged(store.read_table(spark, root, buckets=numbers), last, "post_id", 1)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_hot_keys_are_cut_before_they_move(spark, tmp_path):
    source = rows(spark, 300, "x").unionByName(rows(spark, 400, "y", start=1000).withColumn("post_id", F.lit("p7")))
    keys, numbers, last = buckets._keys_of(source, "post_id", 4, 100)
    assert (keys, sorted(numbers)) == (300, [0, 1, 2, 3]) and last.count() == 300
    assert last.where("post_id = 'p7'").select("ingest_seq", "content").collect() == [(1399, "y")]
    root = str(tmp_path / "t")
    assert buckets.upsert(spark, source, root, "post_id", hot=100).after == 300
    assert store.read_table(spark, root).where("content = 'y'").count() == 1


def test_rows_of_a_bucket_are_spread(spark):
    """Rows of one bucket go to several tasks, those without a key, too."""
    number = buckets._dealt_by(2)
    keyed = rows(spark, 1000, "x").select(number(F.col("post_id"), F.lit(0)).alias("n"), buckets.bucket_of(F.col("post_id"), 2).alias("b")).distinct().collect()
    assert sorted(r["n"] for r in keyed) == list(range(2 * buckets.TASKS_PER_BUCKET)) and all(r["n"] // buckets.TASKS_PER_BUCKET == r["b"] for r in keyed)
    none = F.lit(None).cast("string")
    assert spark.range(1, 1000).select(number(none, F.col("id")).alias("n")).distinct().count() == buckets.TASKS_PER_BUCKET


def test_rated_posts_move_once(spark, tmp_path):
    """Where marks are not broadcast, the join with them finds the posts as they were dealt out before the rules."""
    from postsieve.catalog.base import Tables
    from postsieve.catalog.publishing import rated_posts

    docs = [(i, f"text {i}" if i % 7 else None, "en", "s") for i in range(60)] + [(5, "again", "en", "s"), (None, "none", "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, i % 2) for i in range(0, 40, 3)] + [(3, 0), (None, 1), (6, None)]
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rated = rated_posts(Tables(spark, str(tmp_path)))
        assert rated._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # of posts and of marks
        got = sorted((r["ingest_seq"] or -1, -1 if r["is_ad"] is None else r["is_ad"]) for r in rated.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by = {}
    for k, mark in marks:
        by.setdefault(k, []).append(-1 if mark is None else mark)
    by.pop(None)
    assert got == sorted((k or -1, m) for k, *_ in docs for m in by.get(k, [-1]))
