"""The jobs a user runs. Each reads tables, writes tables, and returns small report frames."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.operators import enrich, features, ingest, labels, metrics, places, publish, qcmodel
from postsieve.operators.dedupe import SEQ, dedupe_keep_first
from postsieve.schemas import EXTRACT_FAILURES, EXTRACTED, POSTS_RAW
from postsieve.session import cut_lineage
from postsieve.sources import buckets, store


def ingest_posts(spark: SparkSession, new: DataFrame, root: str, skip_seen: bool = True, clean: bool = True) -> None:
    """Add newly crawled posts, as tables or CSV bring them, to the post table, which is in date order.

    New rows are numbered behind all stored ones, so they win over older rows of their post.
    """
    old = store.read_table(spark, root, POSTS_RAW)
    shift = old.agg(F.coalesce(F.max(SEQ) + 1, F.lit(0))).first()[0]
    read = ingest.read_lists(new)
    fresh = ingest.as_raw(ingest.clean_posts(read) if clean else read).withColumn(SEQ, F.col(SEQ) + F.lit(shift))
    if skip_seen:
        fresh = ingest.anti_seen_posts(fresh, old)
    store.write_version(ingest.sort_by_date_desc(ingest.append_and_dedupe(old, fresh)), root)


def enrich_posts(
    spark: SparkSession, posts: DataFrame, responses: DataFrame, extracted_root: str, failures_root: str,
    retry_failed: bool = False,
) -> None:
    """Attach recorded answers to pending posts; good ones join the results, the others the failure table.

    The judged rows feed both outputs, so they are written once and read back; of failed ones only what the failure table needs.
    """
    extracted = store.read_table(spark, extracted_root, EXTRACTED)
    failures = store.read_table(spark, failures_root, EXTRACT_FAILURES)
    pending = enrich.pending_posts(posts, extracted, failures, retry_failed)
    hot = enrich.hot_post_keys(posts)
    judged = enrich.with_place(enrich.join_llm_response(pending, responses, hot))
    large = [c for c in ("content", "hashtags", "comments", "response") if c in judged.columns]
    judged = cut_lineage(judged.withColumns({c: F.when(F.col("place").isNotNull(), F.col(c)) for c in large}), "judged")
    new_rows = enrich.extracted_rows(judged)
    store.write_version(enrich.merge_extracted(extracted, new_rows), extracted_root)
    store.write_version(enrich.merge_fail_log(failures, judged, F.current_timestamp()), failures_root)


def label_ads(
    spark: SparkSession, extracted: DataFrame, root: str, thr: int = 30, mode: str = "recall", debug_top: int = 0
) -> tuple[DataFrame, DataFrame | None]:
    """Score and label posts; the table is partitioned by label, so either side is read alone.

    Returns the label distribution and, if asked for, the rows with most points.
    """
    labelled = labels.apply_ad_rules(ingest.normalize_posts(extracted), thr=thr, mode=mode)
    store.write_version(labelled, root, partition_by=["is_ad"])
    stored = store.read_table(spark, root)
    top = labels.top_rule_hits(stored, debug_top) if debug_top > 0 else None
    return labels.label_distribution(stored), top


def match_places(
    spark: SparkSession, labelled: DataFrame, addresses: DataFrame, gazetteer: DataFrame, root: str,
    limit: int = 0, radius_m: float = places.RADIUS_M, nonads_only: bool = True,
) -> DataFrame:
    """Place of every (non-ad) post with an address; returns matched and unmatched counts."""
    posts = places.limit_before_lookup(labels.filter_nonads(labelled, nonads_only), limit)
    matches = cut_lineage(places.match_posts(posts, addresses, gazetteer, radius_m), "matches")
    store.write_version(places.matched_places(matches), root)
    return places.geocode_counts(matches)


def qc_train(
    spark: SparkSession, labelled: DataFrame, id_col: str, model_root: str, cfg: qcmodel.QcConfig = qcmodel.QcConfig(),
    save: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold scores and metric rows per fold and overall; refits on all rows and saves the model."""
    guard = features.class_guard(labelled, cfg.label_col, cfg.n_splits).first()
    if not guard["ok"]:
        raise ValueError(f"training needs two classes of two rows: {guard.asDict()}")
    vectors, vocab = qcmodel.prepared_vectors(labelled, [id_col, cfg.label_col], cfg, guard["folds"])
    scored = cut_lineage(qcmodel.oof_predict(vectors, id_col, cfg, guard["folds"]), "oof")
    report = qcmodel.score_report(scored, cfg.label_col, "oof")
    for k in range(guard["folds"]):
        report = report.unionByName(qcmodel.score_report(scored.where(F.col("fold") == k), cfg.label_col, f"fold {k + 1}"))
    if save:
        model = qcmodel.classifier(cfg, cfg.seed).fit(qcmodel.weighted(vectors, cfg.label_col))
        if vocab is not None:
            store.write_version(vocab.coalesce(1), f"{model_root}/vocabulary")
        model.write().overwrite().save(f"{model_root}/model")
        best = metrics.best_f1_threshold(scored, cfg.label_col, "qc_proba_ad")
        meta = best.withColumns(
            {
                "model": F.lit(cfg.model), "use_text": F.lit(cfg.use_text), "mask_signals": F.lit(cfg.mask_signals),
                "min_df": F.lit(cfg.min_df), "max_features": F.lit(cfg.max_features),
            }
        )
        store.sink_summary(meta, f"{model_root}/meta")
    return scored, report


def score_nonads(df: DataFrame, model_root: str, cfg: qcmodel.QcConfig = qcmodel.QcConfig()) -> DataFrame:
    """Adds the model's probability of being an ad."""
    prepared, numbers = qcmodel.feature_columns(df, cfg)
    vocab = store.read_table(df.sparkSession, f"{model_root}/vocabulary") if store.exists(df.sparkSession, f"{model_root}/vocabulary") else None
    vectors = qcmodel.assemble_features(prepared, numbers, vocab)
    scored = qcmodel.positive_proba(PipelineModel.load(f"{model_root}/model").transform(vectors))
    return scored.select(*df.columns, "qc_proba_ad")


def qc_check(
    spark: SparkSession, nonads: DataFrame, model_root: str, out_root: str, cfg: qcmodel.QcConfig = qcmodel.QcConfig()
) -> DataFrame:
    """Suspect and borderline non-ads and a summary row; empty input gives empty tables and zero counts."""
    scored = cut_lineage(score_nonads(nonads, model_root, cfg), "scored")
    store.write_version(metrics.suspects(scored, threshold=cfg.threshold), f"{out_root}/suspects")
    store.write_version(metrics.borderline(scored, delta=cfg.delta), f"{out_root}/borderline")
    summary = metrics.qc_summary(scored, threshold=cfg.threshold, delta=cfg.delta)
    store.sink_summary(summary, f"{out_root}/summary")
    return summary


def load_target(
    spark: SparkSession, source: DataFrame | None, root: str, key_hint: str = "content", dedupe_content: bool = False
) -> DataFrame | None:
    """Merge one table into its target; None when there is nothing to load.

    Only the buckets of the loaded keys are read and rewritten; dropping rows of equal content needs, and rewrites, the whole table.
    """
    if source is None or source.isEmpty():
        return None
    key = publish.upsert_key(source, fallback=key_hint)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    if not dedupe_content:
        done = buckets.upsert(spark, source, root, key)
        return publish.count_row(spark, name, done.before, done.after)
    before = store.read_table(spark, root, source.schema)
    merged = dedupe_keep_first(publish.merge_upsert(before, source, key), ["content"])
    held = before.count()
    _, counts = store.write_observed(merged, root, rows=F.count(F.lit(1)))
    return publish.count_row(spark, name, held, counts["rows"])


def load_targets(
    spark: SparkSession, tables: dict[str, DataFrame | None], root: str, dedupe_content: bool = False
) -> DataFrame | None:
    """Merge each table into the target of its name; returns one count row per target loaded."""
    rows = [load_target(spark, df, f"{root}/{name}", dedupe_content=dedupe_content) for name, df in tables.items()]
    out = None
    for row in rows:
        if row is not None:
            out = row if out is None else out.unionByName(row)
    if out is not None:
        store.sink_summary(out, f"{root}/load_summary")
    return out
