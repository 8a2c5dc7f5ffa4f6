import math
import random

import pytest
from pyspark.sql import functions as F

from postsieve.functions.geo import EARTH_M, Grid, haversine_m
from postsieve.operators import places as pl
from postsieve.plans import jobs
from postsieve.schemas import GAZETTEER_ADDRESS, GAZETTEER_PLACE
from postsieve.sources import store


def distance(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1, math.sqrt(h)))


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def similar(a, b, percent):
    return edit(a, b) * 100 <= max(len(a), len(b)) * (100 - percent)


def test_grid_finds_every_near_pair(spark):
    """Points on a ring just inside the radius, also at the poles and the date line."""
    rng = random.Random(1)
    pairs = []
    for lat in (0.0, 37.5, -60.0, 89.0, 89.9995, -89.9999, 90.0):
        for lng in (127.0, 179.9999, -180.0, 0.0):
            for _ in range(30):
                bearing, d = rng.uniform(0, 2 * math.pi), 300 * math.sqrt(rng.random()) / EARTH_M
                p = math.radians(lat)
                q = math.asin(max(-1, min(1, math.sin(p) * math.cos(d) + math.cos(p) * math.sin(d) * math.cos(bearing))))
                dl = math.atan2(math.sin(bearing) * math.sin(d) * math.cos(p), math.cos(d) - math.sin(p) * math.sin(q))
                other = (math.degrees(q), (lng + math.degrees(dl) + 180) % 360 - 180)
                pairs.append((lat, lng, *other))
    grid = Grid(300.0)
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double").where(
        haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")) <= 300
    )
    met = F.array_contains(grid.cells_near(F.col("a"), F.col("b")), grid.cell(F.col("c"), F.col("d")))
    assert df.count() > 600 and df.where(~met).count() == 0
    assert df.select(F.max(F.size(grid.cells_near(F.lit(37.5), F.col("b"))))).first()[0] <= 4


NAMES = ["여수식당", "여수 식당 본점", "여수식탁", "김밥", "a", "abcde", "abcdf", "abcdefghij", "abXdefghij", "", "Cafe", "cafe moa", "여수"]


def gazetteer(n, seed):
    rng = random.Random(seed)
    return [
        (rng.choice(NAMES), rng.choice(["FD6", "CE7", None]), None, f"addr{i}", 37.5 + rng.random() * 0.01, 127 + rng.random() * 0.01, i)
        for i in range(n)
    ]


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_radius_search_brute_force(spark, percent):
    listed = gazetteer(120, 3)
    queries = [(rng_name, f"road{i}", 37.5 + i * 0.001, 127.0 + i * 0.0008) for i, rng_name in enumerate(NAMES)]
    got = pl.places_within_radius(
        spark.createDataFrame(queries, "query_name string, road_address string, lat double, lng double"),
        spark.createDataFrame(listed, GAZETTEER_PLACE), 300.0, percent,
    )
    norm = lambda s: "".join(s.split()).lower()
    want = sorted(
        (q[1], p[6]) for q in queries for p in listed
        if norm(q[0]) and norm(p[0]) and distance(q[2:], p[4:6]) <= 300
        and (norm(q[0]) in norm(p[0]) or norm(p[0]) in norm(q[0]) or similar(norm(q[0]), norm(p[0]), percent))
    )
    assert sorted((r["road_address"], r["rank"]) for r in got.collect()) == want and want


def test_similar_names_share_a_piece(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 13))) for _ in range(70)]
    df = spark.createDataFrame([(a, b) for a in words for b in words if similar(a, b, 70) or a in b or b in a], "a string, b string")
    missed = df.where(~F.arrays_overlap(pl.query_keys(F.col("a")), pl.place_keys(F.col("b"), 70)))
    assert missed.count() == 0


def test_low_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        pl.merge_near_places(spark.createDataFrame([], GAZETTEER_PLACE), "rank", 10.0, 50)


def test_no_nested_loop(spark):
    q = spark.createDataFrame([("a", "r", 37.5, 127.0)], "query_name string, road_address string, lat double, lng double")
    df = pl.places_within_radius(q, spark.createDataFrame(gazetteer(5, 1), GAZETTEER_PLACE))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pick(spark):
    cols = "q string, category_group_code string, place_name string, name_hit boolean, rank int, lat double, lng double"
    three = [("x", "CE7", "여수식당", True, 1, 0.0, 0.0), ("x", "FD6", "다른집", False, 2, 0.0, 0.0), ("x", "FD6", "여수식당", True, 3, 0.0, 0.0)]
    pick = lambda rows: pl.pick_best_candidate(spark.createDataFrame(rows, cols), ["q"]).first()["rank"]
    assert pick(three) == 3 and pick(three[:2]) == 2


def test_match_job(spark, tmp_path):
    posts = spark.createDataFrame(
        [(1, "p1", ["여수식당"], ["여수시 중앙동 중앙로 1"], 0), (2, "p2", [], ["여수시 중앙동 중앙로 1"], 0), (3, "p3", ["x"], [], 0),
         (4, "p4", ["x"], ["모르는 주소"], 0), (5, "p5", ["여수식당"], ["여수시 중앙동 중앙로 1"], 1)],
        "ingest_seq long, post_id string, `restaurant name` array<string>, address array<string>, is_ad int",
    )
    addresses = spark.createDataFrame([("여수시 중앙동 중앙로 1", 34.7, 127.7, "중앙동")], GAZETTEER_ADDRESS)
    listed = spark.createDataFrame([("여수식당 본점", "FD6", "중앙로 2", "지번", 34.701, 127.7, 1), ("여수식당", "FD6", None, None, 34.8, 127.7, 1)], GAZETTEER_PLACE)
    counts = jobs.match_places(spark, posts, addresses, listed, str(tmp_path)).first()
    assert (counts["ok"], counts["fail"]) == (2, 2)
    rows = {r["ingest_seq"]: r for r in store.read_table(spark, str(tmp_path)).collect()}
    assert rows[1]["popup"] == "여수식당 본점<br>(중앙로 2)<br><i>keyword+around-addr</i>" and rows[1]["region"] == "중앙동"
    assert rows[2]["source"] == "address" and rows[2]["lat"] == 34.7
    assert pl.limit_before_lookup(posts, 2).count() == 2 and pl.limit_before_lookup(posts, 0).count() == 5


def test_merge_near_brute_force(spark):
    listed = gazetteer(150, 9)
    got = {r["rank"]: r["rep_id"] for r in pl.merge_near_places(spark.createDataFrame(listed, GAZETTEER_PLACE), "rank", 250.0, 80).collect()}
    norm = lambda s: "".join(s.split()).lower()
    near = {
        p[6]: [o[6] for o in listed if norm(o[0]) and norm(p[0]) and similar(norm(o[0]), norm(p[0]), 80) and distance(o[4:6], p[4:6]) <= 250]
        for p in listed
    }
    for p in near:
        met, todo = {p}, [p]
        while todo:
            for o in set(near[todo.pop()]) - met:
                met.add(o)
                todo.append(o)
        assert got[p] == min(met)


def test_pieces_are_never_broadcast(spark):
    """A short list of places has many pieces, so the join by pieces must not go through the driver."""
    queries = spark.createDataFrame([("여수", "a", 34.7, 127.7)], "query_name string, road_address string, lat double, lng double")
    places = spark.createDataFrame([("여수식당", 34.7, 127.7), (None, 34.7, 127.7)], "place_name string, lat double, lng double")
    found = pl.places_within_radius(queries, places)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["place_name"], r["name_hit"]) for r in found.collect()] == [("여수식당", True)]


def test_merge_of_dense_places_links_few_pairs(spark, monkeypatch):
    """Similar places in one spot: links follow the places, not their pairs (F15); groups equal those of all pairs."""
    rows = [(f"cafe{i:06d}" if i % 10 else f"zz bistro{i:05d}", 37.5 + (i % 7) * 0.0004, 127.0 + (i % 5) * 0.0005, i) for i in range(400)]
    links = []
    found = pl.least_reachable
    monkeypatch.setattr(pl, "least_reachable", lambda edges: (links.append(edges.count()), found(edges))[1])
    df = spark.createDataFrame(rows, "place_name string, lat double, lng double, id bigint")
    got = {r["id"]: r["rep_id"] for r in pl.merge_near_places(df, "id", 60.0).collect()}
    assert sum(links) <= 10 * len(rows)
    names = df.withColumn("n", F.translate("place_name", " ", ""))
    a, b = names.alias("a"), names.alias("b")
    near = pl.haversine_m(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")) <= 60.0
    pairs = a.join(b, near & pl.similar_enough(F.col("a.n"), F.col("b.n"), 80)).select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).collect()
    least = {i: i for i in got}
    moved = True
    while moved:
        moved = False
        for x, y in pairs:
            if least[y] < least[x]:
                least[x], moved = least[y], True
    assert got == least


def test_match_query_looks_up_non_ads_only(spark, tmp_path):
    """The query runs the job with its filter: a post that the rules call an ad has no place (F7)."""
    from postsieve.catalog import all_queries

    made = {
        "documents": ([(i, "조용한 밥집", "ko", "x") for i in range(1, 45)], "doc_id long, text string, lang string, source string"),
        "customer": ([(i, f"Customer#{i:09d}", i % 5) for i in range(2000)], "c_custkey long, c_name string, c_nationkey int"),
        "supplier": ([(i, f"Supplier#{i:09d}") for i in range(5)], "s_suppkey long, s_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    queries = all_queries()[0]
    found = {r["ingest_seq"] for r in queries["match_places"](spark, str(tmp_path)).collect()}
    ads = {r["ingest_seq"] for r in queries["ad_label"](spark, str(tmp_path)).where("is_ad = 1").collect()}
    every = {r["ingest_seq"] for r in queries["popup_text"](spark, str(tmp_path)).collect()}
    assert ads & every and found and found == every - ads
