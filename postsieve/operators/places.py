"""Address look-up, radius search by name, choice of a place, and merging of near duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions import coerce, text
from postsieve.functions.geo import Grid, haversine_m
from postsieve.operators.components import least_reachable
from postsieve.operators.dedupe import SEQ
from postsieve.operators.skew import ROWS_PER_TASK, hot_keys, skew_join
from postsieve.schemas import conform, dtype_of
from postsieve.session import cut_lineage

RADIUS_M = 300.0
SIMILARITY = 80  # percent
GRAM = 3  # most characters of a name piece

# Category code of food places, and the source tags of a match.
FOOD = "FD6"
FROM_PLACE = "keyword+around-addr"
FROM_ADDRESS = "address"


def lookup_columns(df: DataFrame) -> DataFrame:
    """Adds query name and road address of each post."""
    df = conform(df)
    name = coerce.first_name(F.col("restaurant_name"), dtype_of(df, "restaurant_name")) if "restaurant_name" in df.columns else F.lit("")
    address = coerce.first_address(F.col("address"), dtype_of(df, "address"))
    return df.withColumns({"query_name": name, "road_address": text.extract_road_address(address)})


def limit_before_lookup(df: DataFrame, n: int) -> DataFrame:
    """First n posts; 0 or less means all. Stated before the joins since the optimizer will not move it there."""
    return df.orderBy(SEQ).limit(n) if n > 0 else df


def geocode_address(queries: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinate (and region, where listed) of each distinct name and address; NULL when unknown.

    Only distinct addresses meet the gazetteer; names are joined to what was found afterwards, and there an address with very
    many names is split. Of several entries of an address the first listed counts (by ``rank``), without ranks the least.
    """
    distinct = queries.where("road_address <> ''").select("query_name", "road_address").distinct()
    facts = F.struct(*[c for c in gazetteer.columns if c not in ("road_address", "rank")])
    first = F.min_by(facts, F.struct("rank", facts)) if "rank" in gazetteer.columns else F.min(facts)
    known = gazetteer.groupBy("road_address").agg(first.alias("facts"))
    found = distinct.select("road_address").distinct().join(known, "road_address").select("road_address", "facts.*")
    return skew_join(distinct, found, ["road_address"], "left", ["query_name"])


def similar_enough(a: Column, b: Column, percent: int) -> Column:
    """Levenshtein similarity, 1 - distance / longer length, of at least ``percent`` / 100."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.levenshtein(a, b) * 100 <= longer * (100 - percent)


def _check(percent: int) -> None:
    if not 50 < percent <= 100:
        raise ValueError("similarity must be above 50 and at most 100 percent")


def names_match(query: Column, candidate: Column, percent: int) -> Column:
    """Containment either way, or similarity; both names normalised and not empty."""
    return (query != "") & (candidate != "") & (
        F.contains(candidate, query) | F.contains(query, candidate) | similar_enough(query, candidate, percent)
    )


def _grams(name: Column) -> Column:
    """All distinct substrings of 1 to GRAM characters."""
    sizes = range(1, GRAM + 1)
    return F.array_distinct(
        F.concat(*[F.regexp_extract_all(name, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1)) for n in sizes])
    )


def _segments(name: Column, percent: int) -> Column:
    """Heads of T+1 near-equal parts of a name, T being the most edits a similar name can be away.

    By the pigeonhole principle a similar name holds one part unchanged, hence also its head.
    """
    size = F.length(name)
    count = F.least(F.floor(size * (100 - percent) / percent) + 1, size).cast("int")
    part = lambda i: F.floor(i * size / count).cast("int")
    heads = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substr(name, part(i) + 1, F.least(part(i + 1) - part(i), F.lit(GRAM))),
    )
    return F.when(size > 0, F.array_distinct(heads)).otherwise(coerce.empty_list())


def _tagged(tag: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(tag), k))


def _head(name: Column) -> Column:
    return F.array(F.substring(name, 1, GRAM))


def query_keys(name: Column) -> Column:
    """Keys of a search name; shares one with ``place_keys`` of every name it can match."""
    return F.concat(_tagged("p", _grams(name)), _tagged("q", _head(name)))


def place_keys(name: Column, percent: int) -> Column:
    """Keys of a listed name: heads of its parts (similar, or contained in a query), and its substrings (contains a query)."""
    return F.concat(_tagged("p", F.array_union(_head(name), _segments(name, percent))), _tagged("q", _grams(name)))


def spread(listed: DataFrame) -> DataFrame:
    """A list dealt out before its pieces are made, since few small tasks hold it and each row becomes some dozens."""
    return listed.repartition(int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def places_within_radius(
    queries: DataFrame, places: DataFrame, radius_m: float = RADIUS_M, percent: int = SIMILARITY
) -> DataFrame:
    """Listed places within the radius of a query's coordinate whose name matches.

    ``queries`` has query_name, road_address, lat, lng. The join key is a grid cell and a piece of the name, so only
    places that are near and share a piece meet; distance and name are then tested exactly. A pair may be found by
    several pieces and is kept once. Adaptive execution splits a crowded cell on both sides of this inner join. It is a merge
    join by hint, since Spark's estimate knows nothing of the pieces: it would broadcast a short list whose pieces fill the driver.
    """
    _check(percent)
    grid = Grid(radius_m)
    q = (
        queries.where("lat is not null and lng is not null")
        .withColumn("q_norm", text.norm_name(F.col("query_name")))
        .where("q_norm <> ''")
        .select(
            "query_name", "road_address", F.col("lat").alias("q_lat"), F.col("lng").alias("q_lng"), "q_norm",
            query_keys(F.col("q_norm")).alias("pieces"),
        )
    )
    probes = q.withColumn("cell", F.explode(grid.cells_near(F.col("q_lat"), F.col("q_lng")))).withColumn(
        "piece", F.explode("pieces")
    )
    p = spread(places).withColumn("p_norm", text.norm_name(F.col("place_name"))).where("p_norm <> ''")
    listed = p.select(
        "*", grid.cell(F.col("lat"), F.col("lng")).alias("cell"),
        F.explode(place_keys(F.col("p_norm"), percent)).alias("piece"),
    )
    near = haversine_m(F.col("q_lat"), F.col("q_lng"), F.col("lat"), F.col("lng")) <= radius_m
    match = names_match(F.col("q_norm"), F.col("p_norm"), percent)
    met = probes.drop("pieces").join(listed.hint("merge"), ["cell", "piece"])
    kept = ["query_name", "road_address", *places.columns]
    contains = F.contains(F.col("p_norm"), F.col("q_norm")).alias("name_hit")
    return met.where(near & match).select(*kept, contains).distinct()


def pick_best_candidate(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """One place per query: food places first, then names that contain the query, then list order.

    Putting food places first equals restricting the choice to them when there are any. Top-1 per group
    is cut map-side, so large groups do not travel.
    """
    food = F.coalesce(F.col("category_group_code") == FOOD, F.lit(False))
    window = W.partitionBy(*keys).orderBy(
        food.desc(), F.col("name_hit").desc(), F.col("rank"), F.col("place_name"), F.col("lat"), F.col("lng")
    )
    return candidates.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def geocode_refine(
    queries: DataFrame, addresses: DataFrame, places: DataFrame, radius_m: float = RADIUS_M, percent: int = SIMILARITY
) -> DataFrame:
    """Per distinct query: the chosen place near the address, else the address itself; none without a coordinate."""
    coords = geocode_address(queries, addresses).where("lat is not null and lng is not null")
    keys = ["query_name", "road_address"]
    best = pick_best_candidate(places_within_radius(coords, places, radius_m, percent), keys).select(
        *keys,
        F.struct(
            F.coalesce(F.nullif("place_name", F.lit("")), F.col("query_name")).alias("place_name"),
            F.coalesce(
                F.nullif("road_address_name", F.lit("")), F.nullif("address_name", F.lit("")), F.col("road_address")
            ).alias("address_name"),
            "lat", "lng", F.lit(FROM_PLACE).alias("source"),
        ).alias("pick"),
    )
    plain = F.struct(
        F.col("query_name").alias("place_name"), F.col("road_address").alias("address_name"), "lat", "lng",
        F.lit(FROM_ADDRESS).alias("source"),
    )
    region = ["region"] if "region" in coords.columns else []
    return coords.join(best, keys, "left").select(*keys, *region, F.coalesce("pick", plain).alias("pick")).select(
        *keys, *region, "pick.*"
    )


def popup_text() -> Column:
    """Marker text of a matched place."""
    return F.concat(
        F.col("place_name"), F.lit("<br>("), F.col("address_name"), F.lit(")<br><i>"), F.col("source"), F.lit("</i>")
    )


def match_posts(
    posts: DataFrame, addresses: DataFrame, places: DataFrame, radius_m: float = RADIUS_M, percent: int = SIMILARITY
) -> DataFrame:
    """Every post with its matched place; columns of the match are NULL where there is none."""
    asked = lookup_columns(posts)
    found = geocode_refine(asked, addresses, places, radius_m, percent)
    keep = [SEQ, *(["post_id"] if "post_id" in asked.columns else []), "query_name", "road_address"]
    joined = skew_join(asked.select(*keep), found, ["query_name", "road_address"], "left", [SEQ])
    return joined.withColumn("popup", popup_text())


def matched_places(matches: DataFrame) -> DataFrame:
    return matches.where("source is not null")


def geocode_counts(matches: DataFrame) -> DataFrame:
    """Matched and unmatched posts; a post without an address counts as unmatched."""
    return matches.agg(
        F.count_if(F.col("source").isNotNull()).alias("ok"), F.count_if(F.col("source").isNull()).alias("fail")
    )


def _near_and_similar(distance_m: float, percent: int) -> Column:
    """Is a place (_name, lat, lng, _marks) near the other one (o_...) and similar? Cheap tests that lose none come first.

    An edit changes at most two marks of a name; the band of the distance has a margin for rounding.
    """
    longer = F.greatest(F.length("_name"), F.length("o_name"))
    most = F.floor(longer * (100 - percent) / 100).cast("int")
    degrees = Grid(distance_m).reach * (1 + 1e-6)
    return (
        (F.bit_count(F.col("_marks").bitwiseXOR(F.col("o_marks"))) <= 2 * most)
        & (F.abs(F.col("lat") - F.col("o_lat")) <= degrees)
        & (haversine_m(F.col("lat"), F.col("lng"), F.col("o_lat"), F.col("o_lng")) <= distance_m)
        & (F.call_function("levenshtein", F.col("_name"), F.col("o_name"), most) >= 0)  # -1 above that many edits
    )


def _marks(name: Column) -> Column:
    """The characters of a name as 64 bits."""
    bits = F.transform(F.split(name, ""), lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def _links_in_order(spots: DataFrame, distance_m: float, percent: int) -> DataFrame:
    """True links (a, b) between places that follow each other by name, or by the name from its end, in small cells.

    These are no more than a few for each place, whatever the density, and leave few groups to compare. Cells of two sizes are laid in four ways, so
    that places on two sides of a border meet, too. An area with more rows than a task should get is split by hashes of names.
    """
    fine, wide = Grid(distance_m / 6), Grid(distance_m / 3)
    lays = [(grid, dy * grid.height / 2, dx * grid.height / 2, grid is wide and dy != dx) for grid in (fine, wide) for dy in (0, 1) for dx in (0, 1)]
    looks = [
        F.struct(
            F.lit(k).alias("lay"), grid.cell(F.col("lat") + dy, F.col("lng") + dx).alias("cell"),
            (F.reverse("_name") if back else F.col("_name")).alias("by"),
        )
        for k, (grid, dy, dx, back) in enumerate(lays)
    ]
    area = spots.withColumn("_area", Grid(distance_m).cell(F.col("lat"), F.col("lng")))
    found = hot_keys(area, ["_area"], ROWS_PER_TASK // 4)  # a cell of a lay meets at most four areas
    marked = area.withColumn("_key_hash", F.xxhash64("_area")).join(F.broadcast(found), "_key_hash", "left")
    laid = marked.withColumn("_look", F.explode(F.array(*looks))).select(*spots.columns, "_fan", "_look.*")
    fan = F.coalesce("_fan", F.lit(1)).cast("bigint")
    dealt = laid.withColumn("_part", F.pmod(F.xxhash64("lay", "_name"), fan))
    order = W.partitionBy("lay", "cell", "_part").orderBy("by", "lat", "lng")
    last = F.lag(F.struct(*[F.col(c).alias(f"o{c if c[0] == '_' else '_' + c}") for c in spots.columns])).over(order)
    met = dealt.select(*spots.columns, last.alias("_last")).select(*spots.columns, "_last.*")
    return met.where(_near_and_similar(distance_m, percent)).select(F.col("_id").alias("a"), F.col("o_id").alias("b"))


def _grouped(spots: DataFrame, least: DataFrame) -> DataFrame:
    """Places with the least id of their group."""
    found = least.select(F.col("node").alias("_id"), F.col("least").alias("_least"))
    return spots.join(found, "_id", "left").withColumn("_group", F.coalesce("_least", "_id")).drop("_least")


def _links_between(grouped: DataFrame, distance_m: float, percent: int) -> DataFrame:
    """All pairs (a, b) of different groups that hold a link, by pieces of names within cells (exact, as in ``query_keys``).

    Groups are numbered by size, and places of the smaller group look for those of the larger one. So where one large group fills a cell, its
    places are not held against each other: they look for nothing, as there is no larger group near them.
    """
    grid = Grid(distance_m, 2.0)
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
    # Numbers rise over sorted partitions, and stay as they are once written.
    ranks = cut_lineage(sizes.orderBy("n", "_group").select("_group", F.monotonically_increasing_id().alias("_rank")), "ranks")
    celled = skew_join(grouped, ranks, ["_group"], "inner", ["_id"]).withColumn("cell", grid.cell(F.col("lat"), F.col("lng")))
    ranked = cut_lineage(celled, "ranked")
    around = F.explode(grid.cells_near(F.col("lat"), F.col("lng")))
    highest = ranked.select(around.alias("cell"), "_rank").groupBy("cell").agg(F.max("_rank").alias("_high"))
    low = cut_lineage(ranked.join(highest.hint("merge"), "cell").where("_rank < _high").drop("_high"), "low")
    probes = spread(low).withColumn("piece", F.explode(_grams(F.col("_name"))))
    others = (
        spread(ranked).drop("cell").withColumn("piece", F.explode(_segments(F.col("_name"), percent))).withColumn("cell", around)
    )
    keys = ["cell", "piece"]
    sought = probes.groupBy(*keys).agg(F.min("_rank").alias("_low"))
    high = others.join(sought.hint("merge"), keys).where("_rank > _low")
    asks = probes.select(*keys, "_group", "_rank", "_name", "lat", "lng", "_marks")
    has = high.select(
        *keys, F.col("_group").alias("o_group"), F.col("_rank").alias("o_rank"), F.col("_name").alias("o_name"),
        F.col("lat").alias("o_lat"), F.col("lng").alias("o_lng"), F.col("_marks").alias("o_marks"),
    )
    met = asks.join(has.hint("merge"), keys).where((F.col("_rank") < F.col("o_rank")) & _near_and_similar(distance_m, percent))
    return met.select(F.col("_group").alias("a"), F.col("o_group").alias("b")).distinct()


def merge_near_places(
    places: DataFrame, id_col: str, distance_m: float = 50.0, percent: int = SIMILARITY
) -> DataFrame:
    """Representative of each place: the least id it reaches over places near each other with similar names.

    Places without a name stay alone. Places with one name at one point are folded first. Neighbours in the order of names are linked and contracted to
    groups; then pieces of names within grid cells bring together all places of different groups that can be similar, and their links
    are contracted, too. Only pairs of different groups are looked at, since a link inside a group changes nothing.
    """
    _check(percent)
    named = places.withColumns({"_name": text.norm_name(F.col("place_name")), "_lat": F.col("lat"), "_lng": F.col("lng")})
    spots = cut_lineage(
        named.where("_name <> ''").groupBy("_name", "lat", "lng").agg(F.min(id_col).alias("_id")).withColumn("_marks", _marks(F.col("_name"))), "spots"
    )
    placed = spots.where("_id is not null and lat is not null and lng is not null")
    least, _ = least_reachable(_links_in_order(placed, distance_m, percent))
    grouped = cut_lineage(_grouped(placed, least), "grouped")
    joint, _ = least_reachable(_links_between(grouped, distance_m, percent))
    ends = joint.select(F.col("node").alias("_group"), F.col("least").alias("_least"))
    reps = skew_join(grouped, ends, ["_group"], "left", ["_id"]).select(
        F.col("_name"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.coalesce("_least", "_group").alias("rep_id")
    )
    merged = skew_join(named, reps, ["_name", "_lat", "_lng"], "left", [id_col])
    return merged.select(*places.columns, F.coalesce("rep_id", id_col).alias("rep_id"))
