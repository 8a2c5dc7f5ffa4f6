"""Places: addresses to coordinates, radius search, choice, merging of duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from postsieve.catalog.base import ADDRESSES_SQL, PLACES_SQL, POSTS, query
from postsieve.catalog.labelling import RULES, labelled
from postsieve.operators import places as pl
from postsieve.plans import jobs
from postsieve.session import cut_lineage, scratch_path
from postsieve.sources import store

HAVERSINE = """6371000.0e0 * 2 * asin(least(1.0e0, sqrt(pow(sin(radians({b}lat - {a}lat) / 2), 2)
    + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lng - {a}lng) / 2), 2))))""".format
NORM = r"lower(regexp_replace({}, '\s+', '', 'g'))".format
# The twin's levenshtein counts bytes, so the Hangul parts of query names become as many ASCII letters.
ASCII = "replace(replace({}, '본점', 'zy'), '없는집', 'xwv')".format


def SIMILAR(a: str, b: str) -> str:  # noqa: N802
    return f"levenshtein({ASCII(a)}, {b}) * 100 <= greatest(length({a}), length({b})) * 20"


ASKED_SQL = r"""asked AS (SELECT ingest_seq, trim(restaurant) AS query_name,
    coalesce(nullif(regexp_extract(address, '[가-힣]+\s[가-힣]+\s[가-힣0-9\-]+(?:로|길)\s*\d+(?:-\d+)?'), ''), trim(coalesce(address, ''))) AS road_address FROM posts),
    lookups AS (SELECT DISTINCT query_name, road_address FROM asked WHERE road_address <> ''),
    coords AS (SELECT query_name, road_address, lat, lng, region FROM lookups LEFT JOIN addresses USING (road_address))"""
CANDIDATES_SQL = f"""candidates AS (SELECT query_name, road_address, p.*, contains(pn, qn) AS name_hit FROM
    (SELECT *, {NORM('query_name')} AS qn FROM coords WHERE lat IS NOT NULL) q, (SELECT *, {NORM('place_name')} AS pn FROM places) p
    WHERE qn <> '' AND pn <> '' AND {HAVERSINE(a='q.', b='p.')} <= 300
      AND (contains(pn, qn) OR contains(qn, pn) OR {SIMILAR(a='qn', b='pn')}))"""
BEST_SQL = """best AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY query_name, road_address
    ORDER BY (coalesce(category_group_code, '') = 'FD6') DESC, name_hit DESC, rank, place_name, lat, lng) = 1)"""
REFINED_SQL = """refined AS (SELECT c.query_name, c.road_address, c.region,
    coalesce(b.place_name, c.query_name) AS place_name,
    CASE WHEN b.place_name IS NULL THEN c.road_address ELSE coalesce(b.road_address_name, b.address_name) END AS address_name,
    coalesce(b.lat, c.lat) AS lat, coalesce(b.lng, c.lng) AS lng,
    CASE WHEN b.place_name IS NULL THEN 'address' ELSE 'keyword+around-addr' END AS source
    FROM coords c LEFT JOIN best b USING (query_name, road_address) WHERE c.lat IS NOT NULL)"""
MATCHED_SQL = "matched AS (SELECT a.ingest_seq, r.* FROM asked a LEFT JOIN refined r USING (query_name, road_address))"
GEO = (POSTS, ADDRESSES_SQL, PLACES_SQL, ASKED_SQL)


def asked(t):
    return pl.lookup_columns(t.posts.withColumnRenamed("restaurant", "restaurant_name"))


def rounded(name: str):
    return F.round(name, 7).alias(name)


@query("geocode_address", "SELECT query_name, road_address, round(lat, 7) AS lat, round(lng, 7) AS lng FROM coords", *GEO)
def geocode_address(t):
    return pl.geocode_address(asked(t), t.addresses).select("query_name", "road_address", rounded("lat"), rounded("lng"))


@query("attach_region", "SELECT query_name, road_address, region FROM coords", *GEO)
def attach_region(t):
    return pl.geocode_address(asked(t), t.addresses).select("query_name", "road_address", "region")


def candidates(t):
    coords = pl.geocode_address(asked(t), t.addresses).drop("region")
    return pl.places_within_radius(coords, t.places)


@query(
    "places_within_radius",
    "SELECT query_name, road_address, place_key, place_name, name_hit FROM candidates", *GEO, CANDIDATES_SQL,
)
def places_within_radius(t):
    return candidates(t).select("query_name", "road_address", "place_key", "place_name", "name_hit")


@query(
    "pick_best_candidate",
    "SELECT query_name, road_address, place_key, category_group_code, rank FROM best", *GEO, CANDIDATES_SQL, BEST_SQL,
)
def pick_best_candidate(t):
    best = pl.pick_best_candidate(candidates(t), ["query_name", "road_address"])
    return best.select("query_name", "road_address", "place_key", "category_group_code", "rank")


@query(
    "geocode_refine",
    "SELECT query_name, road_address, region, place_name, address_name, round(lat, 7) AS lat, round(lng, 7) AS lng, source FROM refined",
    *GEO, CANDIDATES_SQL, BEST_SQL, REFINED_SQL,
)
def geocode_refine(t):
    return pl.geocode_refine(asked(t), t.addresses, t.places).select(
        "query_name", "road_address", "region", "place_name", "address_name", rounded("lat"), rounded("lng"), "source"
    )


def matches(t):
    return pl.match_posts(t.posts.withColumnRenamed("restaurant", "restaurant_name"), t.addresses, t.places)


MATCH = (*GEO, CANDIDATES_SQL, BEST_SQL, REFINED_SQL, MATCHED_SQL)


NONADS_SQL = ASKED_SQL.replace("FROM posts)", "FROM labelled WHERE is_ad = 0)", 1)


@query(
    "match_places", "SELECT ingest_seq, place_name, address_name, source FROM matched WHERE source IS NOT NULL",
    *RULES, ADDRESSES_SQL, PLACES_SQL, NONADS_SQL, CANDIDATES_SQL, BEST_SQL, REFINED_SQL, MATCHED_SQL,
)
def match_places(t):
    """The job over all posts as the rules label them: only non-ads are looked up, matches are read from what was written."""
    rated = labelled(t).select("ingest_seq", "post_id", F.col("restaurant").alias("restaurant_name"), "address", "is_ad")
    root = scratch_path(t.spark, "places")
    jobs.match_places(t.spark, cut_lineage(rated, "labelled"), t.addresses, t.places, root)  # rules are costly, posts are read twice
    return store.read_table(t.spark, root).select("ingest_seq", "place_name", "address_name", "source")


@query(
    "popup_text",
    "SELECT ingest_seq, place_name || '<br>(' || address_name || ')<br><i>' || source || '</i>' AS popup FROM matched WHERE source IS NOT NULL", *MATCH,
)
def popup_text(t):
    return pl.matched_places(matches(t)).select("ingest_seq", "popup")


@query("geocode_counts", "SELECT count(*) FILTER (source IS NOT NULL) AS ok, count(*) FILTER (source IS NULL) AS fail FROM matched", *MATCH)
def geocode_counts(t):
    return pl.geocode_counts(matches(t))


@query(
    "limit_before_lookup",
    """SELECT a.ingest_seq, round(lat, 7) AS lat FROM (SELECT * FROM asked ORDER BY ingest_seq LIMIT 80) a LEFT JOIN
       (SELECT road_address, lat FROM addresses) USING (road_address)""",
    *GEO,
)
def limit_before_lookup(t):
    first = pl.limit_before_lookup(asked(t), 80)
    return first.join(t.addresses, "road_address", "left").select("ingest_seq", rounded("lat"))


@query(
    "merge_near_places",
    f"""SELECT * FROM (WITH RECURSIVE near AS (SELECT a.place_key AS a, b.place_key AS b FROM (SELECT *, {NORM('place_name')} AS n FROM places) a
        JOIN (SELECT *, {NORM('place_name')} AS n FROM places) b ON {HAVERSINE(a='a.', b='b.')} <= 200 AND {SIMILAR(a='a.n', b='b.n')}),
        reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a)
        SELECT a AS place_key, min(b) AS rep_id FROM reach GROUP BY a)""",
    PLACES_SQL,
)
def merge_near_places(t):
    return pl.merge_near_places(t.places, "place_key", 200.0).select("place_key", "rep_id")
