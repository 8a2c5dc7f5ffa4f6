"""Mix sources to target weights along a curriculum, with DataFrame functions only.

Each source has a weight that changes over training time u in [0, 1]; its integral, scaled to the source's target, is the
demand for words up to u. Documents of a source stand in a fixed order on a line of words, pass after pass; inverting the
demand at the place of a document gives its training position, by which the result is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.llm.common import WORD
from postsieve.session import cut_lineage

WEIGHTS = (3, 1, 2)
SLOPES = (0.5, -0.5, 0.0)  # how a weight moves over time: later, earlier, even


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS, slopes=SLOPES) -> DataFrame:
    """Word target and slope per source: rows of (source, source_size) to (source, source_size, target, slope).

    Weights repeat over the sources by code point, null last. No target exceeds ``most`` times its source; what is over goes
    to the others by weight. Sorted by (limit / weight), the sources at their limit come first, so running sums give the level.
    One row per source goes through one window.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    ranked = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1).alias("w"),
        F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), place % len(slopes) + 1).alias("slope"),
        place.alias("place"),
    ).withColumns({"limit": F.col("source_size") * F.lit(float(most)), "all": F.lit(1)})
    by_fill = W.partitionBy("all").orderBy(F.col("limit") / F.col("w"), "place")
    everything = W.partitionBy("all")
    filled = F.coalesce(F.sum("limit").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("w").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - filled) / open_weight
    leveled = ranked.withColumns({"level": level, "nth": F.row_number().over(by_fill)})
    first_open = F.min(F.when(F.col("level") <= F.col("limit") / F.col("w"), F.struct("nth", "level"))).over(everything)
    return leveled.withColumn("at", first_open["level"]).select(
        "source", "source_size", F.least("limit", F.coalesce(F.col("at") * F.col("w"), F.col("limit"))).alias("target"), "slope"
    )


def position_at(words, target, slope):
    """Training time at which the demand of a source reaches ``words``: the inverse of target * ((1 - k) u + k u^2)."""
    part = words / target
    straight = F.lit(1.0) - slope
    return F.lit(2.0) * part / (straight + F.sqrt(straight * straight + F.lit(4.0) * slope * part))


def mix_sources(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", carry: list[str] | None = None,
    share: float = 1.5, most: float = 2.0, weights=WEIGHTS, slopes=SLOPES, buckets: int = 4096,
) -> DataFrame:
    """Plan of the mix, one row per document: the carried columns (default: the key) and ``_mix`` with size, source_size,
    target, taken (words, repeats counted), copies, position (of the first copy) and positions (of all copies).

    Documents of a source are ordered by a hash of key and text, in ``buckets`` parts of that hash: bucket totals give each
    part its start, so a source with any share of the rows is spread over that many groups. A copy is taken if its middle lies
    below the target, so a source misses its target by half a document at most. Documents without words (null texts too) are
    taken once with size 0. A null source is a source of its own. Equal rows are interchangeable. Empty tables give no rows.
    """
    carry = [key] if carry is None else carry
    order = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(
        F.struct(*carry).alias("row"), F.col(source).alias("source"), order.alias("h"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    ).withColumn("bucket", F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int"))
    if text not in carry:  # narrow rows are counted once and reread; whole texts are rather counted twice than written
        sized = cut_lineage(sized, "mix")
    parts = cut_lineage(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-parts")
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), share, most, weights, slopes)
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        parts.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("bucket").alias("part"), "start", "source_size", "target", "slope")
    )
    inside = W.partitionBy("source", "bucket").orderBy("h", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        sized.withColumn("c", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("part")))
        .withColumn("c", F.col("c") + F.col("start"))
    )
    passes = -(-int(most * 1000) // 1000)
    at = lambda j: F.col("c") + F.col("source_size") * j
    taken = lambda j: (at(j) + F.col("size") / 2 < F.col("target")) | (F.lit(j == 0) & (F.col("size") == 0))
    where = lambda j: F.when(F.col("target") > 0, position_at(at(j), F.col("target"), F.col("slope"))).otherwise(F.lit(0.0))
    positions = F.filter(F.array(*[F.when(taken(j), where(j)) for j in range(passes)]), lambda p: p.isNotNull())
    placed = placed.withColumn("positions", positions).withColumn("copies", F.size("positions"))
    return placed.select(
        "row.*",
        F.struct(
            "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies",
            F.get("positions", F.lit(0)).alias("position"), "positions", "h",
        ).alias("_mix"),
    )


def spread_order(mix: str = "_mix"):
    """Sort key: the position; documents that are not taken follow in the order of their hash, so that no single key is hot."""
    late = F.lit(1.0) + F.conv(F.substring(F.col(mix)["h"], 9, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return F.coalesce(F.col(mix)["position"], late)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in training order, each as often as it is taken; columns as in ``docs``."""
    plan = mix_sources(docs, carry=docs.columns, **options)
    copies = plan.select(*docs.columns, F.explode("_mix.positions").alias("_mix_at"))
    return copies.repartitionByRange("_mix_at").sortWithinPartitions("_mix_at").drop("_mix_at")
