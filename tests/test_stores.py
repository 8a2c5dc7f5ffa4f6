import pytest
from pyspark.sql import functions as F

from postsieve.operators import publish
from postsieve.plans import jobs
from postsieve.sources import csvfiles, store


def test_upsert_golden(spark):
    target = spark.createDataFrame([("k1", 1, 2), (None, 5, 5), (None, 6, 6)], "k string, a int, b int")
    source = spark.createDataFrame([(1, "k1", 8), (2, "k1", 9), (3, "k2", 5), (4, None, 7), (5, " ", 7)], "ingest_seq long, k string, a int")
    once = publish.merge_upsert(target, source, "k").drop("ingest_seq")
    want = [("k1", 9, 2), ("k2", 5, None), (None, 5, 5), (None, 6, 6)]
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(want, key=repr)
    twice = publish.merge_upsert(once, source, "k").drop("ingest_seq")
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(want, key=repr)


def test_upsert_sets_null(spark):
    target = spark.createDataFrame([("k", 1)], "k string, a int")
    source = spark.createDataFrame([("k", None)], "k string, a int")
    assert publish.merge_upsert(target, source, "k").first()["a"] is None
    assert publish.upsert_key(target) == "content" and publish.upsert_key(target, "k") == "k"


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, root)
    assert store.write_version(spark.range(1), root) == 1
    # A merge reads the version it replaces.
    assert store.write_version(store.read_table(spark, root).union(spark.range(2)), root) == 2
    assert store.read_table(spark, root).count() == 3
    (tmp_path / "t" / "v=00000002" / "_SUCCESS").unlink()
    assert store.read_table(spark, root).count() == 1


def test_load_targets(spark, tmp_path):
    posts = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "y")], "ingest_seq long, post_id string, content string")
    report = jobs.load_targets(spark, {"all": posts, "empty": posts.where("false"), "none": None}, str(tmp_path))
    assert [tuple(r) for r in report.collect()] == [("all", 0, 2, 2)]
    report = jobs.load_targets(spark, {"all": posts.withColumn("content", F.lit("same"))}, str(tmp_path), dedupe_content=True)
    assert [tuple(r) for r in report.collect()] == [("all", 2, 1, -1)]


def test_csv_round_trip(spark, tmp_path):
    text = 'line one\nline "two", with comma\n  blanks  '
    posts = spark.createDataFrame([("1", text, ["#맛집"])], "post_id string, content string, hashtags array<string>")
    path = str(tmp_path / "csv")
    csvfiles.sink_posts_csv(posts, path)
    back = csvfiles.scan_posts_csv(spark, path, "post_id string, content string, hashtags string").first()
    assert (back["content"], back["hashtags"]) == (text, '["#맛집"]')


def test_encodings(spark, tmp_path):
    body = "post_id,content\n1,맛집\n2,\"여수\n식당\"\n"
    for name, encoding in {"bom": "utf-8-sig", "plain": "utf-8", "korean": "cp949", "euckr": "euc-kr"}.items():
        (tmp_path / f"{name}.csv").write_bytes(body.encode(encoding))
    (tmp_path / "latin.csv").write_bytes("post_id,content\n9,caf\xe9 cr\xe8me\n".encode("latin-1"))
    (tmp_path / "long.csv").write_bytes(("post_id,content\n8," + "맛집" * 60000 + "\n").encode("cp949"))
    rows = csvfiles.scan_csv_encodings(spark, str(tmp_path), "post_id string, content string").collect()
    got = sorted((r["post_id"], r["content"] if len(r["content"]) < 20 else len(r["content"])) for r in rows)
    assert got == sorted([("1", "맛집"), ("2", "여수\n식당")] * 4 + [("9", "café crème"), ("8", 120000)])
    forced = csvfiles.scan_csv_encodings(spark, str(tmp_path / "korean.csv"), "post_id string, content string", first_choice="MS949")
    assert forced.count() == 2


def test_load_posts_routes(spark, tmp_path):
    (tmp_path / "p.csv").write_text("post_id,content,likes,hashtags,comments,date,search_tag\nA,one,\"1,200\",\"[\"\"#x\"\"]\",,2025-08-01,t\nA,two,5,,,,t\n")
    posts = store.load_posts(spark, "auto", str(tmp_path / "p.csv"), drop_duplicates_on="post_id").collect()
    assert [(r["content"], r["likes"]) for r in posts] == [("two", 5)]
    store.write_version(spark.createDataFrame([(1, "A", "5")], "ingest_seq long, post_id string, likes string"), str(tmp_path / "s"))
    assert store.load_posts(spark, "auto", str(tmp_path / "no.csv"), str(tmp_path / "s")).first()["likes"] == 5
    for kwargs in ({"source": "mongo"}, {"source": "csv"}, {"source": "store"}):
        with pytest.raises(ValueError):
            store.load_posts(spark, **kwargs)


def test_find_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 5 as k", "cast(id as string) as wide").write.parquet(str(tmp_path / "p"))
    df = store.store_find(spark.read.parquet(str(tmp_path / "p")), "k = 3", ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan and "wide" not in plan.split("ReadSchema")[1]
    assert store.store_count(df).first()["n"] == 20


def test_label_job(spark, tmp_path):
    extracted = spark.createDataFrame([(1, "#광고 x", "2025-08-01"), (2, "맛있다", "")], "ingest_seq long, content string, date string")
    counts, top = jobs.label_ads(spark, extracted, str(tmp_path), debug_top=1)
    assert counts.first()["pos"] == 1 and top.first()["content"] == "#광고 x"
    jobs.ingest_posts(spark, extracted.withColumn("post_id", F.lit("a")).select(*[F.col(c) for c in ("ingest_seq", "post_id", "content", "date")]).withColumns({c: F.lit(None).cast(t) for c, t in {"likes": "string", "hashtags": "array<string>", "comments": "array<string>", "search_tag": "string"}.items()}), str(tmp_path / "raw"))
    assert store.read_table(spark, str(tmp_path / "raw")).first()["date"] == "2025-08-01"


def test_plain_files_are_split_over_tasks(spark, tmp_path):
    head, rows = "post_id,content\n", [f'{i},"say ""{i}"", please"\n' for i in range(3000)]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.csv").write_text(head + "".join(rows))
    schema, was = "post_id string, content string", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = csvfiles.scan_posts_csv(spark, str(tmp_path / "plain"), schema)
        assert found.rdd.getNumPartitions() > 3 and found.count() == 3000
        assert {r["content"] for r in found.collect()} == {f'say "{i}", please' for i in range(3000)}
        (tmp_path / "plain" / "b.csv").write_text(head + '7,"two\nlines, ""quoted"""\n8,x\n')  # both kinds in one folder
        mixed = csvfiles.scan_csv_encodings(spark, str(tmp_path / "plain"), schema)
        assert mixed.count() == 3002 and mixed.where("content = 'two\\nlines, \"quoted\"'").count() == 1
        (tmp_path / "c.csv").write_text(head + '7,"two\nlines"\n' * 2000)
        assert csvfiles.scan_posts_csv(spark, str(tmp_path / "c.csv"), schema).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_split_files_keep_their_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("post_id,content,likes,hashtags,comments,date,search_tag\n" + "".join(f"p{i % 50},text {i},1,[],,,t\n" for i in range(4000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = store.read_landing(spark, str(tmp_path)).orderBy("ingest_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [(r["ingest_seq"], r["content"]) for r in rows] == [(i, f"text {i}") for i in range(4000)]


def test_korean_csv_in_a_session_of_few_charsets(spark, tmp_path):
    """Korean files are written, told and read where the session does not open Spark to the charsets of Java."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        rows = spark.createDataFrame([("1", "서울 맛집"), ("2", '여수, "식당"')], "post_id string, content string")
        csvfiles.sink_posts_csv(rows, str(tmp_path / "korean"), "MS949")
        (tmp_path / "broken.csv").write_bytes("post_id,content\n3,서울".encode("cp949") + b"\x80!\n")
        told = csvfiles.scan_csv_encodings(spark, str(tmp_path / "korean"), "post_id string, content string")
        forced = csvfiles.scan_csv_encodings(spark, str(tmp_path / "*"), "post_id string, content string", first_choice="MS949")
        assert spark.conf.get(name) == "false"
        assert sorted(map(tuple, told.collect())) == [("1", "서울 맛집"), ("2", '여수, "식당"')]
        assert sorted(map(tuple, forced.collect())) == [("1", "서울 맛집"), ("2", '여수, "식당"'), ("3", "서울�!")]
    finally:
        spark.conf.set(name, before)
