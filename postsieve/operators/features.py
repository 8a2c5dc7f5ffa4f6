"""Features of the label check: masked text, counts, character n-grams, tf-idf, folds and weights."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions import adwords as words
from postsieve.functions import coerce, text
from postsieve.functions.text import SP
from postsieve.operators import termvectors
from postsieve.schemas import dtype_of
from postsieve.session import cut_lineage

MIN_DF = 3
MAX_FEATURES = 40_000
GRAM_SIZES = (3, 4, 5)
BUCKET_DIGITS = 4


def _first_of(patterns: list[str]) -> str:
    """Ordered alternation, case ignored; the look-ahead dismisses most positions by one plain test of few ranges.

    It lets pass all Korean syllables where a pattern begins with one, and letters in any case: ignoring case there, or listing syllables, costs each character many tests.
    """
    heads = {p[0] for p in patterns}
    korean = {h for h in heads if "\uac00" <= h <= "\ud7a3"}
    folds = {f for h in heads - korean for f in (h.lower(), h.upper())}
    letters = "".join(c for c in map(chr, range(0x2130)) if c.lower() in folds or c.upper() in folds)
    return f"(?=[{letters}{r'\uac00-\ud7a3' if korean else ''}])(?iu:{'|'.join(patterns)})"


def mask_rule_signals(col: Column) -> Column:
    """Tags, ad words, calls to act, links and phone numbers blanked in this order; blanks collapsed."""
    out = F.coalesce(col, F.lit(""))
    for pattern in (
        rf"#[^{SP}]+",
        _first_of(list(map(re.escape, words.MASK_AD_WORDS))),
        _first_of(list(map(re.escape, words.MASK_CTA_WORDS))),
        _first_of([p.replace(r"\S", f"[^{SP}]") for p in words.MASK_LINKS]),
        rf"(?U)(?=01)(?<!\d){words.PHONE_BODY}(?!\d)",
        rf"[{SP}]+",
    ):
        out = F.regexp_replace(out, pattern, " ")
    return text.strip(out)


def text_stats(col: Column) -> dict[str, Column]:
    """Characters, words, marks, digits and pictographs of a text."""
    t = F.coalesce(col, F.lit(""))
    patterns = {
        "words": rf"[^{SP}]+", "exc": "!", "q": r"\?", "digits": r"(?U)\d",
        "emoji": r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}]",
    }
    return {"len": F.length(t), **{k: F.regexp_count(t, F.lit(p)) for k, p in patterns.items()}}


def extra_stats(df: DataFrame) -> dict[str, Column]:
    """Features of the optional columns that are present."""
    out: dict[str, Column] = {}
    for name in ("likes", "views", "bookmarks"):
        if name in df.columns:
            out[f"{name}_log1p"] = coerce.log1p_feature(F.col(name))
    if "comments" in df.columns:
        out["comment_count"] = coerce.comment_count(F.col("comments"), dtype_of(df, "comments"))
    if "hashtags" in df.columns:
        tags = F.col("hashtags")
        is_list = dtype_of(df, "hashtags").startswith("array")
        marks = F.regexp_count(F.coalesce(tags.cast("string"), F.lit("")), F.lit("#")) if not is_list else None
        out["hashtag_count"] = F.coalesce(F.size(tags), F.lit(0)) if is_list else marks
    for name in ("image_count", "video_count", "media_count"):
        if name in df.columns:
            out[name] = F.coalesce(coerce.numeric(F.col(name)), F.lit(0.0))
    return out


def plain_words(col: Column) -> Column:
    """Lower-cased words between single blanks, one blank at either end."""
    single = text.strip(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), rf"[{SP}]+", " "))
    return F.concat(F.lit(" "), single, F.lit(" "))


def char_wb_ngrams(words_col: Column, sizes: tuple[int, ...] = GRAM_SIZES) -> Column:
    """Character n-grams inside words, each word padded by one blank on either side.

    In text of ``plain_words`` these are the runs of n characters that have no blank but at an end. One look-ahead
    per start position finds them without splitting the text into words.
    """
    return F.concat(
        *[F.regexp_extract_all(words_col, F.lit(rf"(?s)(?=(.[^ ]{{{n - 2}}}.))."), F.lit(1)) for n in sizes]
    )


def vocab_top_k(df: DataFrame, words_col: str, min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """Most frequent terms among those in at least ``min_df`` rows: term, df, tf, in rising order of ``position``.

    Terms lie inside words, so frequencies come from one row per distinct word, weighted by its count. Terms are then taken
    from the most frequent on, a bounded portion at a time; only theirs document counts are made, until enough of them
    are in ``min_df`` rows. All terms before the last one taken have been counted, so the choice is exact.
    """
    split = F.filter(F.split(F.col(words_col), " "), lambda w: w != "")
    word_counts = df.select(F.explode(split).alias("_w")).groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    padded = F.concat(F.lit(" "), F.col("_w"), F.lit(" "))
    tf = word_counts.select("_n", F.explode(char_wb_ngrams(padded)).alias("term")).groupBy("term").agg(F.sum("_n").alias("tf"))
    tf = cut_lineage(tf.where(F.col("tf") >= min_df), "terms")  # a term is in no more rows than it occurs
    portion = max(2 * max_features, 1000)
    chosen: list[tuple[str, int, int]] = []
    rest, more = tf, True
    while more and len(chosen) < max_features:
        found = rest.orderBy(F.col("tf").desc(), "term").limit(portion).collect()
        more = len(found) == portion
        if found:
            counted = termvectors.document_counts(df, words_col, [r["term"] for r in found], GRAM_SIZES).where(F.col("df") >= min_df)
            held = {r["position"]: r["df"] for r in counted.collect()}
            chosen += [(r["term"], held[i], r["tf"]) for i, r in enumerate(found) if i in held]
            last = found[-1]
            rest = tf.where((F.col("tf") < last["tf"]) | ((F.col("tf") == last["tf"]) & (F.col("term") > last["term"])))
    rows = [(i, *r) for i, r in enumerate(chosen[:max_features])]
    return df.sparkSession.createDataFrame(rows, "position int, term string, df bigint, tf bigint")


def smooth_idf(df_count: Column, rows: Column) -> Column:
    return F.ln((rows + 1) / (df_count + 1)) + 1


def with_idf(vocab: DataFrame, rows: int) -> DataFrame:
    """The vocabulary with the smoothed idf of each term."""
    return vocab.withColumn("idf", smooth_idf(F.col("df"), F.lit(rows)))


def tfidf(df: DataFrame, words_col: str, vocab: DataFrame, out: str = "_tfidf", numbers: list[str] | None = None) -> DataFrame:
    """Adds term counts times idf, rows scaled to length 1, as a sparse vector, behind numeric columns if there are any.

    The vocabulary, at most max_features short strings with ``position`` and ``idf``, goes to every task; rows are not shuffled.
    """
    terms = vocab.orderBy("position").select("term", "idf").collect()
    return termvectors.with_vectors(df, words_col, [t["term"] for t in terms], [t["idf"] for t in terms], GRAM_SIZES, out, numbers)


def stored_tfidf(df: DataFrame, words_col: str, vocab: DataFrame, out: str, numbers: list[str], keep: list[str]) -> DataFrame:
    """The vectors of ``tfidf`` next to columns to keep, for frames that are read often.

    Terms are looked up once; gaps between their positions and their counts are written, two or three bytes an entry where a vector needs twelve.
    """
    terms = vocab.orderBy("position").select("term", "idf").collect()
    counts = termvectors.with_counts(df, words_col, [t["term"] for t in terms], GRAM_SIZES, [*keep, *numbers])
    stored = cut_lineage(counts, "counts", compression="zstd")
    return stored.select(*keep, termvectors.weighed([t["idf"] for t in terms], numbers).alias(out))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and balanced weight n / (2 * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("weight", total / (F.col("n") * 2.0))


def class_guard(df: DataFrame, label: str, n_splits: int = 5) -> DataFrame:
    """One row: classes, size of the smaller one, folds that can be made of it, and whether training may start."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("minority"), F.sum("n").alias("total"))
    return facts.withColumns(
        {
            "folds": F.greatest(F.lit(2).cast("bigint"), F.least(F.lit(n_splits).cast("bigint"), F.col("minority"))),
            "ok": (F.col("classes") >= 2) & (F.col("minority") >= 2),
        }
    )


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..k-1: rows of a class dealt out in the order of a seeded hash.

    A row number over a whole class would need one task per class. Here hash prefixes cut a class into
    many buckets; a row's number is its number in its bucket plus the rows of the buckets before. Offsets are at most
    16**BUCKET_DIGITS rows per class, which bounds the window over them and the broadcast.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    marked = df.withColumn("_h", digest).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    keys = [label, "_bucket"]
    before = W.partitionBy(label).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.row_number().over(W.partitionBy(*keys).orderBy("_h", id_col)) - 1
    return (
        marked.withColumn("_number", number)
        .join(F.broadcast(offsets), keys)
        .withColumn("fold", F.pmod(F.col("_number") + F.col("_offset"), F.lit(k)).cast("int"))
        .drop("_h", "_bucket", "_number", "_offset")
    )
