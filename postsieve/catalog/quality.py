"""Label check: features, folds, models and metrics."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.catalog.base import POSTS, SCORED_SQL, query
from postsieve.catalog.columns import MASKED_SQL
from postsieve.operators import features as fx
from postsieve.operators import metrics as mx
from postsieve.operators import qcmodel as qc
from postsieve.operators.termvectors import entries
from postsieve.plans import jobs
from postsieve.session import cut_lineage, scratch_path
from postsieve.sources import store

CURVE_SQL = """curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
    FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM scored GROUP BY score)
    WINDOW w AS (ORDER BY score DESC)),
    points AS (SELECT *, tp / (tp + fp) AS pr, tp / p_all AS rc FROM curve),
    f1s AS (SELECT *, 2 * pr * rc / (pr + rc + 1e-9) AS f1 FROM points)"""


def r9(name: str):
    return F.round(name, 9).alias(name)


@query(
    "pr_curve",
    "SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(pr, 9) AS precision, round(rc, 9) AS recall FROM points",
    SCORED_SQL, CURVE_SQL,
)
def pr_curve(t):
    return mx.pr_curve(t.scored, "label", "score").select("score", "tp", "fp", r9("precision"), r9("recall"))


@query("average_precision", "SELECT round(sum(pos * tp / (tp + fp)) / max(p_all), 9) AS average_precision FROM curve", SCORED_SQL, CURVE_SQL)
def average_precision(t):
    return mx.average_precision(t.scored, "label", "score").select(r9("average_precision"))


@query(
    "roc_auc",
    """SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0e0 WHEN a.score = b.score THEN 0.5e0 ELSE 0 END) / count(*), 9) AS roc_auc
       FROM (SELECT * FROM scored WHERE label = 1) a, (SELECT * FROM scored WHERE label = 0) b""",
    SCORED_SQL,
)
def roc_auc(t):
    return mx.roc_auc(t.scored, "label", "score").select(r9("roc_auc"))


@query(
    "confusion_metrics",
    """SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy FROM
       (SELECT count(*) FILTER (score >= 0.35e0 AND label = 1) AS tp, count(*) FILTER (score >= 0.35e0 AND label <> 1) AS fp,
               count(*) FILTER (score < 0.35e0 AND label = 1) AS fn, count(*) FILTER (score < 0.35e0 AND label <> 1) AS tn FROM scored)""",
    SCORED_SQL,
)
def confusion_metrics(t):
    m = mx.confusion_metrics(t.scored, "label", "score", 0.35)
    return m.select("tp", "fp", "fn", "tn", *[r9(c) for c in ("precision", "recall", "f1", "accuracy")])


@query(
    "best_f1_threshold",
    """SELECT score AS threshold, coalesce((SELECT max(score) FROM scored s WHERE s.score < b.score), 0.0e0) AS threshold_compat,
       round(pr, 9) AS precision, round(rc, 9) AS recall, round(f1, 9) AS f1 FROM (SELECT * FROM f1s ORDER BY f1 DESC, score LIMIT 1) b""",
    SCORED_SQL, CURVE_SQL,
)
def best_f1_threshold(t):
    b = mx.best_f1_threshold(t.scored, "label", "score")
    return b.select("threshold", "threshold_compat", r9("precision"), r9("recall"), r9("f1"))


@query(
    "qc_summary",
    """SELECT count(*) AS nonads, count(*) FILTER (score >= 0.35e0) AS suspects, count(*) FILTER (abs(score - 0.5e0) <= 0.15e0 + 1e-9) AS borderline,
       0.35e0 AS thr, round(avg(score), 9) AS avg_proba, round(quantile_cont(score, 0.9), 9) AS p90_proba FROM scored""",
    SCORED_SQL,
)
def qc_summary(t):
    s = mx.qc_summary(t.scored, "score")
    return s.select("nonads", "suspects", "borderline", "thr", r9("avg_proba"), r9("p90_proba"))


@query(
    "quantile_events", "SELECT round(quantile_cont(value, 0.9), 9) AS p90, round(quantile_cont(value, 0.5), 9) AS median FROM events",
)
def quantile_events(t):
    p90 = mx.exact_quantile(t["events"], "value", 0.9)
    return p90.select(r9("quantile").alias("p90"), F.round(mx.exact_quantile(t["events"], "value", 0.5).scalar(), 9).alias("median"))


@query("suspects", "SELECT doc_id, score FROM scored WHERE score >= 0.35e0", SCORED_SQL)
def suspects(t):
    return mx.suspects(t.scored, "score").select("doc_id", "score")


@query("borderline", "SELECT doc_id, score FROM scored WHERE abs(score - 0.5e0) <= 0.15e0 + 1e-9", SCORED_SQL)
def borderline(t):
    return mx.borderline(t.scored, "score").select("doc_id", "score")


@query(
    "class_guard",
    """SELECT count(*) AS classes, min(n) AS minority, CAST(sum(n) AS BIGINT) AS total, greatest(2, least(5, min(n))) AS folds, count(*) >= 2 AND min(n) >= 2 AS ok
       FROM (SELECT label, count(*) AS n FROM scored GROUP BY label)""",
    SCORED_SQL,
)
def class_guard(t):
    return fx.class_guard(t.scored, "label")


@query(
    "class_weights",
    "SELECT label, count(*) AS n, round((SELECT count(*) FROM scored) / (2.0e0 * count(*)), 9) AS weight FROM scored GROUP BY label", SCORED_SQL,
)
def class_weights(t):
    return fx.class_weights(t.scored, "label").select("label", "n", r9("weight"))


@query(
    "stratified_folds",
    "SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', cast(doc_id AS string))), doc_id) - 1) % 5 AS INT) AS fold FROM scored",
    SCORED_SQL,
)
def stratified_folds(t):
    return fx.stratified_folds(t.scored, "doc_id", "label", 5).select("doc_id", "label", "fold")


@query(
    "text_stats",
    r"""SELECT ingest_seq, length(content) AS len, length(list_filter(string_split_regex(content, '\s+'), lambda x: x <> '')) AS words,
        length(content) - length(replace(content, '!', '')) AS exc, length(content) - length(replace(content, '?', '')) AS q,
        length(content) - length(regexp_replace(content, '\d', '', 'g')) AS digits, CAST(0 AS BIGINT) AS emoji FROM posts""",
    POSTS,
)
def text_stats(t):
    return t.posts.select("ingest_seq", *[v.cast("bigint").alias(k) for k, v in fx.text_stats(F.col("content")).items()])


@query(
    "extra_stats",
    r"""SELECT ingest_seq, round(ln(1 + coalesce(try_cast(likes AS DOUBLE), 0)), 9) AS likes_log1p,
        CAST(CASE ingest_seq % 4 WHEN 0 THEN 3 WHEN 3 THEN 1 ELSE 0 END AS BIGINT) AS comment_count,
        length(coalesce(hashtags_json, '')) - length(replace(coalesce(hashtags_json, ''), '#', '')) AS hashtag_count FROM posts""",
    POSTS,
)
def extra_stats(t):
    loose = t.posts.select("ingest_seq", "likes", F.col("comments_text").alias("comments"), F.col("hashtags_json").alias("hashtags"))
    stats = fx.extra_stats(loose)
    return loose.select(
        "ingest_seq", F.round(stats["likes_log1p"], 9).alias("likes_log1p"),
        *[stats[k].cast("bigint").alias(k) for k in ("comment_count", "hashtag_count")],
    )


GRAMS_SQL = f"""flat AS (SELECT ingest_seq, unnest(list_filter(string_split_regex(lower({MASKED_SQL}), '\\s+'), lambda x: x <> '')) AS word FROM posts),
    padded AS (SELECT ingest_seq, ' ' || word || ' ' AS w FROM flat),
    sized AS (SELECT ingest_seq, w, unnest([3, 4, 5]) AS n FROM padded),
    grams AS (SELECT ingest_seq, substr(w, i, n) AS term FROM (SELECT ingest_seq, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM sized WHERE n <= length(w)))"""


def words(t):
    return t.posts.select("ingest_seq", fx.plain_words(fx.mask_rule_signals(F.col("content"))).alias("words"))


@query(
    "char_wb_ngrams",
    """SELECT p.ingest_seq, count(term) AS n, count(DISTINCT term) AS n_distinct, min(term) AS first_term, max(term) AS last_term
       FROM posts p LEFT JOIN grams g ON p.ingest_seq = g.ingest_seq GROUP BY p.ingest_seq""",
    POSTS, GRAMS_SQL,
)
def char_wb_ngrams(t):
    g = F.col("grams")
    return words(t).withColumn("grams", fx.char_wb_ngrams(F.col("words"))).select(
        "ingest_seq", F.size(g).cast("bigint").alias("n"), F.size(F.array_distinct(g)).cast("bigint").alias("n_distinct"),
        F.array_min(g).alias("first_term"), F.array_max(g).alias("last_term"),
    )


VOCAB_SQL = """vocab AS (SELECT term, count(DISTINCT ingest_seq) AS df, count(*) AS tf FROM grams GROUP BY term HAVING count(DISTINCT ingest_seq) >= 3
    ORDER BY tf DESC, term LIMIT 40000)"""


@query("vocab_top_k", "SELECT term, df, tf FROM vocab", POSTS, GRAMS_SQL, VOCAB_SQL)
def vocab_top_k(t):
    return fx.vocab_top_k(cut_lineage(words(t), "words"), "words").drop("position")


@query(
    "tfidf",
    """SELECT ingest_seq, count(*) AS terms, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS peak FROM
       (SELECT ingest_seq, w, sqrt(sum(w * w) OVER (PARTITION BY ingest_seq)) AS norm FROM
         (SELECT ingest_seq, g.term, count(*) * (ln(((SELECT count(*) FROM posts) + 1) / (any_value(df) + 1)) + 1) AS w FROM grams g JOIN vocab v ON g.term = v.term GROUP BY ingest_seq, g.term))
       GROUP BY ingest_seq""",
    POSTS, GRAMS_SQL, VOCAB_SQL,
)
def tfidf(t):
    w = cut_lineage(words(t), "words")  # masked text is costly and read three times
    vectors = fx.tfidf(w, "words", fx.with_idf(fx.vocab_top_k(w, "words"), w.count()))
    return (
        vectors.select("ingest_seq", F.unwrap_udt("_tfidf")["values"].alias("w")).where(F.size("w") > 0)
        .select(
            "ingest_seq", F.size("w").cast("bigint").alias("terms"),
            F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(F.array_max("w"), 6).alias("peak"),
        )
    )


# Models of the full size, as QcConfig has them, for the query that is about the models.
WHOLE = qc.QcConfig(label_col="label")
# One model size for the other checks: features, vocabulary and folds are those of QcConfig, trees, their depth and rounds are fewer.
CHECKED = qc.QcConfig(model="rf", trees=10, forest_depth=5, rounds=2, label_col="label")
LABELLED = POSTS.removesuffix("documents)") + "documents WHERE doc_id IN (SELECT doc_id FROM labels))"


def labelled_posts(t):
    marks = t["labels"].select(F.col("doc_id").alias("ingest_seq"), F.col("quality").alias("label"))
    return t.posts_raw.join(marks, "ingest_seq")


def vectors(t, cfg=CHECKED, folds=0):
    return qc.prepared_vectors(labelled_posts(t), ["ingest_seq", "label"], cfg, folds)[0]


FEATURES_SQL = r"""stats AS (SELECT ingest_seq, unnest([
      length(content), length(list_filter(string_split_regex(content, '\s+'), lambda x: x <> '')), length(content) - length(replace(content, '!', '')),
      length(content) - length(replace(content, '?', '')), length(content) - length(regexp_replace(content, '\d', '', 'g')), 0,
      ln(1 + coalesce(try_cast(likes AS DOUBLE), 0)), CASE WHEN ingest_seq % 4 IN (0, 3) THEN 1 ELSE 0 END, CASE WHEN ingest_seq % 5 < 3 THEN 1 ELSE 0 END]::DOUBLE[]) AS value,
      unnest(range(0, 9)) AS position FROM posts),
    placed AS (SELECT *, row_number() OVER (ORDER BY tf DESC, term) + 8 AS position FROM vocab),
    weights AS (SELECT ingest_seq, v.position, count(*) * (ln(((SELECT count(*) FROM posts) + 1) / (any_value(df) + 1)) + 1) AS w FROM grams g JOIN placed v ON g.term = v.term GROUP BY ingest_seq, v.position),
    features AS (SELECT ingest_seq, position, value FROM stats WHERE value <> 0
      UNION ALL SELECT ingest_seq, position, w / sqrt(sum(w * w) OVER (PARTITION BY ingest_seq)) FROM weights)"""


@query(
    "assemble_features", "SELECT ingest_seq, CAST(position AS INT) AS position, round(value, 6) AS value FROM features",
    LABELLED, GRAMS_SQL, VOCAB_SQL, FEATURES_SQL,
)
def assemble_features(t):
    """All entries of all feature vectors that are not zero."""
    return entries(vectors(t), "raw_features", "ingest_seq").withColumn("value", F.round("value", 6))


@query(
    "scale_features",
    """SELECT f.ingest_seq, CAST(f.position AS INT) AS position, round(f.value / d.deviation, 6) AS value FROM features f JOIN
       (SELECT position, sqrt((sum(value * value) - sum(value) * sum(value) / n) / (n - 1)) AS deviation
        FROM features, (SELECT count(*)::DOUBLE AS n FROM posts) GROUP BY position, n) d ON f.position = d.position WHERE deviation > 1e-9""",
    LABELLED, GRAMS_SQL, VOCAB_SQL, FEATURES_SQL,
)
def scale_features(t):
    v = vectors(t)
    scaled = qc.classifier(CHECKED, 1).getStages()[0].fit(v).transform(v)
    return entries(scaled, "features", "ingest_seq").withColumn("value", F.round("value", 6))


def in_range(proba):
    return F.coalesce(proba.between(0, 1), F.lit(False)).alias("in_range")


@query(
    "classifier",
    "SELECT kind, ingest_seq, true AS in_range FROM posts, (SELECT unnest(['rf', 'lgbm', 'xgb']) AS kind)", LABELLED,
)
def classifier(t):
    """One fit of each model kind, in its full size, on all labelled posts; every row gets one probability from each."""
    v = vectors(t, WHOLE)
    train = qc.weighted(v, "label")
    kinds = ("rf", "lgbm", "xgb")

    def scored(kind):
        found = qc.positive_proba(qc.classifier(replace(WHOLE, model=kind), 42).fit(train).transform(v))
        return found.select(F.lit(kind).alias("kind"), "ingest_seq", in_range(F.col("qc_proba_ad")))

    with ThreadPool(len(kinds)) as pool:  # boosted trees follow each other, so that one fit leaves most cores idle
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(v.sparkSession)(scored), kinds))


FOLDS_SQL = """marked AS (SELECT doc_id, quality AS label FROM labels),
    dealt AS (SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', cast(doc_id AS string))), doc_id) - 1) % 5 AS INT) AS fold FROM marked)"""


@query("oof_predict", "SELECT doc_id AS ingest_seq, CAST(label AS BIGINT) AS label, fold, true AS in_range FROM dealt", FOLDS_SQL)
def oof_predict(t):
    """Every labelled post gets one probability, from the model that was not fitted on its fold."""
    scored = qc.oof_predict(vectors(t, CHECKED, CHECKED.n_splits), "ingest_seq", CHECKED, CHECKED.n_splits)
    return scored.select("ingest_seq", F.col("label").cast("bigint").alias("label"), "fold", in_range(F.col("qc_proba_ad")))


@query(
    "refit_and_save",
    "SELECT part, true AS in_range FROM (SELECT 'oof' AS part UNION ALL SELECT DISTINCT concat('fold ', cast(fold + 1 AS string)) FROM dealt)", FOLDS_SQL,
)
def refit_and_save(t):
    """The training job with saving on; its metric rows, overall and per fold, all between 0 and 1."""
    _, report = jobs.qc_train(t.spark, labelled_posts(t), "ingest_seq", scratch_path(t.spark, "model"), CHECKED)
    measured = [c for c in report.columns if c != "part"]
    sound = reduce(lambda a, b: a & b, [F.col(c).between(0, 1) for c in measured])
    return report.select("part", F.coalesce(sound, F.lit(False)).alias("in_range"))


def checked(t, name):
    """The model trained, saved and loaded, and the check job run over the posts of the negative class."""
    root = scratch_path(t.spark, name)
    jobs.qc_train(t.spark, labelled_posts(t), "ingest_seq", f"{root}/model", CHECKED)
    nonads = labelled_posts(t).where("label = 0")
    return root, nonads


@query("score_nonads", "SELECT doc_id AS ingest_seq, true AS in_range FROM labels WHERE quality = 0")
def score_nonads(t):
    """Train, save, load, and score the posts of the negative class."""
    root, nonads = checked(t, "score")
    return jobs.score_nonads(nonads, f"{root}/model", CHECKED).select("ingest_seq", in_range(F.col("qc_proba_ad")))


@query(
    "job_qc_check",
    """SELECT doc_id AS ingest_seq, true AS in_range, true AS flags_agree, count(*) OVER () AS nonads, true AS counts_agree FROM labels WHERE quality = 0""",
)
def job_qc_check(t):
    """The check job over all non-ads: each row with its probability, its presence among suspects and borderline rows, and the summary's counts."""
    root, nonads = checked(t, "check")
    summary = jobs.qc_check(t.spark, nonads, f"{root}/model", f"{root}/out", CHECKED)
    scored = jobs.score_nonads(nonads, f"{root}/model", CHECKED).select("ingest_seq", "qc_proba_ad")
    for name in ("suspects", "borderline"):
        listed = store.read_table(t.spark, f"{root}/out/{name}").groupBy("ingest_seq").agg(F.count(F.lit(1)).alias(name))
        scored = scored.join(listed, "ingest_seq", "left")
    told = summary.select("nonads", "suspects", "borderline").first()
    p = F.col("qc_proba_ad")
    flags = (F.coalesce("suspects", F.lit(0)) == (p >= CHECKED.threshold).cast("int")) & (
        F.coalesce("borderline", F.lit(0)) == (F.abs(p - 0.5) <= CHECKED.delta + 1e-9).cast("int")
    )
    sums = scored.agg(F.count("suspects").alias("s"), F.count("borderline").alias("b"))
    counts = (sums.select("s").scalar() == told["suspects"]) & (sums.select("b").scalar() == told["borderline"])
    return scored.select("ingest_seq", in_range(p), flags.alias("flags_agree"), F.lit(told["nonads"]).alias("nonads"), counts.alias("counts_agree"))
