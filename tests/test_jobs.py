"""The jobs one after another, from CSV files to the targets, and what once broke between them."""

import os

import pytest
from pyspark.sql import functions as F

from postsieve.operators import ingest, labels, places, publish
from postsieve.plans import jobs
from postsieve.session import shared_dir
from postsieve.sources import csvfiles, store
from postsieve.streaming import ingest as stream

HEADER = "post_id,content,likes,hashtags,comments,date,search_tag\n"


def landing(folder, name, rows, at):
    path = folder / name
    path.write_text(HEADER + "".join(rows))
    os.utime(path, (at, at))


def test_csv_to_targets(spark, tmp_path):
    csv, root = tmp_path / "csv", str(tmp_path / "tables")
    csv.mkdir()
    landing(csv, "a.csv", ['p1,first,1.2k,"[""#a""]","[""c\u0327a"", ""b""]",2025-08-01,t\n', "p2,#광고 구매링크 https://x 010-1234-5678,many,[],,2025-08-03,t\n"], 1000)
    jobs.ingest_posts(spark, store.read_landing(spark, str(csv)), f"{root}/posts")
    stored = store.read_table(spark, f"{root}/posts")
    assert [r["post_id"] for r in stored.collect()] == ["p2", "p1"]  # newest first
    rows = {r["post_id"]: r for r in stored.collect()}
    assert rows["p1"]["likes"] == "1200" and rows["p1"]["comments"] == ["ça", "b"]
    assert int(rows["p2"]["likes"]) >= 1  # estimated
    report, _ = jobs.label_ads(spark, stored, f"{root}/labelled")
    assert tuple(report.first())[:3] == (1, 1, 2)
    labelled = store.read_table(spark, f"{root}/labelled")
    loaded = jobs.load_targets(spark, {"all_post": labelled, "ads": labelled.where("is_ad = 1")}, f"{root}/targets")
    assert sorted(tuple(r) for r in loaded.collect()) == [("ads", 0, 1, 1), ("all_post", 0, 2, 2)]
    again = jobs.load_targets(spark, {"all_post": labelled}, f"{root}/targets")
    assert [tuple(r) for r in again.collect()] == [("all_post", 2, 2, 0)]
    assert store.read_table(spark, f"{root}/targets/all_post").where("map_contains_key(rule_why, 'hash')").count() == 1


def test_newer_file_wins_though_it_is_larger(spark, tmp_path):
    landing(tmp_path, "z.csv", ["A,old,1,[],,,t\n"], 1000)
    landing(tmp_path, "b.csv", ["A,new,1,[],,,t\n"] + [f"x{i},{'long ' * 40},1,[],,,t\n" for i in range(300)], 2000)
    posts = store.load_posts(spark, "csv", str(tmp_path), drop_duplicates_on="post_id")
    assert posts.where("post_id = 'A'").first()["content"] == "new"


def test_later_run_wins(spark, tmp_path):
    root = str(tmp_path / "posts")
    for text in ("one", "two", "three"):
        new = spark.createDataFrame([(5, "A", text), (6, "B", "b")], "ingest_seq long, post_id string, content string")
        jobs.ingest_posts(spark, new, root, skip_seen=False)
    assert sorted(r["content"] for r in store.read_table(spark, root).collect()) == ["b", "three"]


def test_rows_without_an_id_all_stay(spark, tmp_path):
    rows = [(1, None), (2, None), (3, ""), (4, " "), (5, "A"), (6, "A")]
    store.write_version(spark.createDataFrame(rows, "ingest_seq long, post_id string"), str(tmp_path))
    got = store.load_posts(spark, "store", store_root=str(tmp_path), drop_duplicates_on="post_id")
    assert sorted(r["ingest_seq"] for r in got.collect()) == [1, 2, 3, 4, 6]


def test_every_row_gets_a_label(spark):
    rows = [(1, "x", ["#x", None]), (2, "x", [None]), (3, "x", None), (4, None, ["#협찬", None]), (5, None, None)]
    df = spark.createDataFrame(rows, "ingest_seq long, content string, hashtags array<string>")
    for mode in ("recall", "balanced"):
        rated = labels.apply_ad_rules(df, mode=mode)
        nonads, ads = labels.split_by_label(rated)
        assert nonads.count() + ads.count() == 5
        assert [r["ingest_seq"] for r in ads.collect()] == [4]


def test_merge_takes_maps_and_spreads_blank_keys(spark):
    target = spark.createDataFrame([("k", {"a": True}), (" ", {}), (" ", {"b": True}), (None, None)], "k string, why map<string,boolean>")
    source = spark.createDataFrame([("k", {"c": True}), ("", {})], "k string, why map<string,boolean>")
    got = publish.merge_upsert(target, source, "k").collect()
    assert len(got) == 4
    assert {r["k"]: r["why"] for r in got}["k"] == {"c": True}


def test_chain_of_near_places_is_one(spark):
    step = 35 / 111_195  # degrees of latitude
    rows = [(i, "Han River Cafe", 37.5 + step * i, 127.0) for i in (3, 1, 2, 0, 4, 5)] + [(9, "Han River Cafe", 38.0, 127.0), (8, "", 37.5, 127.0)]
    df = spark.createDataFrame(rows, "id long, place_name string, lat double, lng double")
    got = {r["id"]: r["rep_id"] for r in places.merge_near_places(df, "id", 50.0).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 9: 9, 8: 8}


def test_first_listed_address_counts(spark):
    asked = spark.createDataFrame([("n", "road 1")], "query_name string, road_address string")
    listed = spark.createDataFrame([("road 1", 2.0, 2.0, 0), ("road 1", 1.0, 1.0, 1)], "road_address string, lat double, lng double, rank int")
    assert places.geocode_address(asked, listed).first()["lat"] == 2.0


def test_date_fill_stays_linear(spark):
    """Half a minute would do for a tenth of this with frames that reach to the end."""
    rows = spark.range(150_000).select(F.col("id").alias("ingest_seq"), F.lit("p").alias("post_id"), F.when(F.col("id") == 149_999, "2025-01-01").alias("date"))
    filled = ingest.fill_date(rows)
    assert filled.where("date <> '2025-01-01'").count() == 0
    assert "unboundedfollowing" not in filled._jdf.queryExecution().toString().lower()


def test_stream_orders_files_by_age(spark, tmp_path):
    land, root = tmp_path / "landing", str(tmp_path / "store")
    land.mkdir()
    schema = "post_id string, content string, date string"
    for name, rows, at in (("z.json", ["old"], 1000), ("a.json", ["new"] + ["filler"] * 200, 2000)):
        lines = [f'{{"post_id": "{"A" if i == 0 else f"{name}{i}"}", "content": "{text}"}}\n' for i, text in enumerate(rows)]
        (land / name).write_text("".join(lines))
        os.utime(land / name, (at, at))
    stream.ingest_stream(spark, str(land), root, str(tmp_path / "cp"), schema, fmt="json").awaitTermination()
    got = stream.read_posts(spark, root, spark.createDataFrame([], schema + ", ingest_seq long").schema)
    assert got.where("post_id = 'A'").first()["content"] == "new"


def test_csv_starts_with_a_mark(spark, tmp_path):
    csvfiles.sink_posts_csv(spark.createDataFrame([("1", "x")], "post_id string, content string").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfpost_id,content")
    assert csvfiles.scan_posts_csv(spark, str(tmp_path / "out"), "post_id string, content string").first()["post_id"] == "1"


def test_a_cluster_must_name_its_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_many_splits_of_many_files_stay_in_order(spark, tmp_path):
    """Row ids jump by 2^33 from split to split: numbers of a batch must not reach into those of the next one."""
    land, root = tmp_path / "landing", str(tmp_path / "store")
    land.mkdir()
    schema = "post_id string, content string, date string"
    for i in range(24):
        (land / f"{23 - i:02}.json").write_text("".join(f'{{"post_id": "p{j}", "content": "{i} {j}"}}\n' for j in range(400)))
        os.utime(land / f"{23 - i:02}.json", (1000 + i, 1000 + i))
    kept = spark.createDataFrame([], schema + ", ingest_seq long").schema
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert spark.read.schema(schema).json(str(land)).rdd.getNumPartitions() > 300
        stream.ingest_stream(spark, str(land), root, str(tmp_path / "cp"), schema, fmt="json").awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    first = {r["post_id"]: r for r in stream.read_posts(spark, root, kept).collect()}
    assert [first[f"p{j}"]["content"] for j in range(400)] == [f"23 {j}" for j in range(400)]
    assert [first[f"p{j}"]["ingest_seq"] for j in range(400)] == list(range(23 * 400, 24 * 400))
    (land / "new.json").write_text("".join(f'{{"post_id": "p{j}", "content": "new"}}\n' for j in range(380)))
    stream.ingest_stream(spark, str(land), root, str(tmp_path / "cp"), schema, fmt="json").awaitTermination()
    stream.compact(spark, root, upto=0, schema=kept)
    rows = stream.read_posts(spark, root, kept)
    assert rows.where("content = 'new'").count() == 380 and rows.where("content = '23 399'").count() == 1
    assert rows.where("content = 'new'").agg(F.min("ingest_seq")).first()[0] == 24 * 400


def test_later_batch_wins_whatever_its_numbers(spark, tmp_path):
    schema = "post_id string, content string, date string, ingest_seq long"
    for batch, rows in enumerate([[("A", "one", "d1", 900), ("B", "b", "", 901)], [("A", "two", "", 5)], [("A", "three", "", 7), ("B", "c", "d2", 1)]]):
        stream.write_batch(spark.createDataFrame(rows, schema), batch, str(tmp_path))
        if batch == 1:
            stream.compact(spark, str(tmp_path), upto=0, schema=spark.createDataFrame([], schema).schema)
    got = stream.read_posts(spark, str(tmp_path), spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, got.collect())) == [("A", "three", "d1", 7), ("B", "c", "d2", 1)]
