"""Rule-based ad scoring and labelling of posts."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions import adwords as words
from postsieve.functions import coerce
from postsieve.functions.text import SP, contains_any, fold_tags, hashtags_loose, normalize_nfkc
from postsieve.operators.dedupe import SEQ
from postsieve.schemas import dtype_of, require

SIGNALS = ["hash", "kw", "kw_simple", "cta", "link", "phone"]


def _holds_other(phrase: list[str], others: list[list[str]]) -> bool:
    n = len(phrase)
    return any(
        o != phrase and o in [phrase[i : i + len(o)] for i in range(n - len(o) + 1)] for o in others
    )


def lean_phrases() -> list[list[str]]:
    """Korean phrases without those that contain a shorter listed one, which cannot change the outcome."""
    return [p for p in words.KEY_PHRASES if not _holds_other(p, words.KEY_PHRASES)]


def korean_pattern() -> str:
    gap = words.LETTER_GAP
    phrases = [f"[{SP}]*".join(gap.join(map(re.escape, part)) for part in phrase) for phrase in lean_phrases()]
    heads = "".join(sorted({p[0][0] for p in lean_phrases()}))
    return f"(?=[{heads}])(?:{'|'.join(phrases)})"


def english_pattern() -> str:
    """Whole words. The first two letters are tested as a pair, since word boundaries are costly to test."""
    phrases = [f"[{SP}]*".join(parts).lower() for parts in words.KEY_WORDS]
    first, second = ("".join(sorted({p[i] for p in phrases})) for i in (0, 1))
    return rf"(?U)(?=[{first}][{second}])\b(?:{'|'.join(phrases)})\b"


def tags_union(tags: Column, text: Column) -> Column:
    """Folded column tags and folded tags of the text, as one set."""
    return F.array_union(fold_tags(tags), fold_tags(hashtags_loose(text)))


def tag_dictionary_match(tags: Column) -> Column:
    """Does a folded tag set meet the ad dictionary? The dictionary is a literal of fixed size."""
    folded = sorted({t.lower().lstrip("#") for t in words.AD_TAGS})
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in folded])), F.lit(False))


def rule_kw(lowered: Column) -> Column:
    """Key phrase in a lower-cased text. The Korean pattern only runs where all letters of one phrase occur."""
    letters = [sorted(set("".join(phrase))) for phrase in lean_phrases()]
    possible = reduce(or_, [reduce(and_, [F.contains(lowered, F.lit(c)) for c in some]) for some in letters])
    return F.when(possible, lowered.rlike(korean_pattern())).otherwise(False) | lowered.rlike(english_pattern())


def rule_kw_simple(lowered: Column) -> Column:
    return contains_any(lowered, words.SIMPLE_WORDS)


def rule_cta(lowered: Column) -> Column:
    return contains_any(lowered, words.CTA_WORDS)


def rule_link(lowered: Column) -> Column:
    return contains_any(lowered, words.LINKS)


def rule_phone(text: Column) -> Column:
    return text.rlike(rf"(?U)(?<!\d){words.PHONE_BODY}(?!\d)")


def fired(rule: Column) -> Column:
    """A rule that cannot tell, as on a NULL text, has not fired: every row gets a label."""
    return F.coalesce(rule, F.lit(False))


def ad_signals(df: DataFrame, content_col: str = "content", hashtags_col: str = "hashtags") -> DataFrame:
    """Adds one boolean per rule, named ``why_<signal>``.

    The normalised text and its lower-case form are projection steps of their own: Catalyst keeps them apart because
    several rules use them.
    """
    require(df, content_col)
    if hashtags_col not in df.columns:
        tags = coerce.empty_list()
    elif dtype_of(df, hashtags_col).startswith("array"):
        tags = F.coalesce(F.col(hashtags_col), coerce.empty_list())
    else:
        tags = coerce.coerce_tags(F.col(hashtags_col))
    text, lowered = F.col("_text"), F.col("_lowered")
    tested = (
        df.withColumn("_text", normalize_nfkc(F.col(content_col).cast("string")))
        .withColumn("_lowered", F.lower(text))
        .withColumns(
            {
                "why_hash": tag_dictionary_match(tags_union(tags, text)),
                "why_kw": fired(rule_kw(lowered)),
                "why_cta": fired(rule_cta(lowered)),
                "why_link": fired(rule_link(lowered)),
                "why_phone": fired(rule_phone(text)),
            }
        )
        .withColumn("why_kw_simple", F.when(F.col("why_kw"), False).otherwise(fired(rule_kw_simple(lowered))))
        .drop("_text", "_lowered")
    )
    # Handing the results through a generator keeps Catalyst from moving a later filter on labels below the rules,
    # where it would evaluate them a second time. Filters on other columns still reach the scan.
    names = [f"why_{s}" for s in SIGNALS]
    once = F.inline(F.array(F.struct(*[F.col(n) for n in names])))
    return tested.select(*[c for c in tested.columns if c not in names], once)


def ad_score() -> Column:
    """Points of the signals present, at most 100."""
    points = [F.when(F.col(f"why_{s}"), words.POINTS[s]).otherwise(0) for s in SIGNALS]
    return F.least(sum(points[1:], points[0]), F.lit(100))


def rule_why() -> Column:
    """Map of the signals that fired."""
    pairs = [part for s in SIGNALS for part in (F.lit(s), F.col(f"why_{s}"))]
    return F.map_filter(F.create_map(*pairs), lambda _, fired: fired)


def ad_label(thr: int, mode: str, score: Column | None = None) -> Column:
    """0/1 label; ``balanced`` wants support for a keyword, ``recall`` does not."""
    why = {s: F.col(f"why_{s}") for s in SIGNALS}
    score = F.col("rule_score") if score is None else score
    keyword = why["kw"] | why["kw_simple"]
    if mode == "recall":
        hit = why["hash"] | keyword | (why["link"] & why["cta"]) | why["phone"] | (score >= thr)
    elif mode == "balanced":
        hit = why["hash"] | (keyword & (why["link"] | why["cta"] | why["phone"])) | (score >= thr)
    else:
        raise ValueError(f"mode must be balanced or recall, not {mode!r}")
    return hit.cast("int")


def apply_ad_rules(
    df: DataFrame, content_col: str = "content", hashtags_col: str = "hashtags", thr: int = 40,
    mode: str = "balanced", keep_signals: bool = False,
) -> DataFrame:
    """Adds rule_score, rule_why and is_ad. No shuffle: every rule is an expression over its own row."""
    scored = (
        ad_signals(df.drop("rule_score", "rule_why", "is_ad"), content_col, hashtags_col)
        .withColumn("rule_score", ad_score())
        .withColumns({"rule_why": rule_why(), "is_ad": ad_label(thr, mode)})
    )
    return scored if keep_signals else scored.drop(*[f"why_{s}" for s in SIGNALS])


def label_distribution(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ads, non-ads, rows and the share of ads in percent (0 when there are no rows)."""
    return (
        df.groupBy(*(by or []))
        .agg(
            F.count_if(F.col("is_ad") == 1).alias("pos"),
            F.count_if(F.col("is_ad") == 0).alias("neg"),
            F.count(F.lit(1)).alias("total"),
        )
        .withColumn("ratio", F.coalesce(F.try_divide(F.col("pos") * 100.0, F.col("total")), F.lit(0.0)))
    )


def top_rule_hits(df: DataFrame, n: int, columns: list[str] | None = None) -> DataFrame:
    """The n rows with most points."""
    wanted = columns or [c for c in ("content", "rule_score", "rule_why", "is_ad", "hashtags") if c in df.columns]
    return df.orderBy(F.col("rule_score").desc(), F.col(SEQ)).limit(n).select(*wanted)


def split_by_label(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Non-ads and ads; rows without a label are in neither."""
    require(df, "is_ad")
    return df.where("is_ad = 0"), df.where("is_ad = 1")


def filter_nonads(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Non-ads only, where the column exists and the filter is on."""
    return df.where("is_ad = 0") if enabled and "is_ad" in df.columns else df
