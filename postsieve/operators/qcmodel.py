"""Label-check model: feature vectors, out-of-fold scores, final fit and scoring, as Spark ML stages."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.operators import features as fx
from postsieve.operators.metrics import (
    average_precision, best_f1_threshold, confusion_metrics, roc_auc,
)
from postsieve.operators.sparsetrees import SparseTrees
from postsieve.session import cut_lineage


@dataclass(frozen=True)
class QcConfig:
    """Settings of the check; the defaults, fixed values, are the full size, tests use less."""

    model: str = "lgbm"
    use_text: bool = True
    mask_signals: bool = True
    min_df: int = fx.MIN_DF
    max_features: int = fx.MAX_FEATURES
    rounds: int = 600
    trees: int = 400
    forest_depth: int = 12
    n_splits: int = 5
    seed: int = 42
    threshold: float = 0.35
    delta: float = 0.15
    content_col: str = "content"
    label_col: str = "is_ad"
    extra: dict = field(default_factory=dict)


def feature_columns(df: DataFrame, cfg: QcConfig) -> tuple[DataFrame, list[str]]:
    """Adds numeric features and, when text is used, the n-grams of the masked text."""
    text = F.col(cfg.content_col)
    numbers = {f"x_{k}": v.cast("double") for k, v in {**fx.text_stats(text), **fx.extra_stats(df)}.items()}
    out = df.withColumns(numbers)
    if cfg.use_text:
        masked = fx.mask_rule_signals(text) if cfg.mask_signals else F.coalesce(text, F.lit(""))
        out = out.withColumn("_words", fx.plain_words(masked))
    return out, list(numbers)


def vocabulary(prepared: DataFrame, cfg: QcConfig) -> DataFrame | None:
    """Terms of the texts with their idf; None where texts are not used or have no terms."""
    if not cfg.use_text:
        return None
    vocab = fx.with_idf(fx.vocab_top_k(prepared, "_words", cfg.min_df, cfg.max_features), prepared.count())
    return None if vocab.isEmpty() else vocab


def assemble_features(prepared: DataFrame, numbers: list[str], vocab: DataFrame | None) -> DataFrame:
    """Adds ``raw_features``: numeric columns next to length-1 tf-idf vectors, sparse all along."""
    if vocab is None:
        return VectorAssembler(inputCols=numbers, outputCol="raw_features", handleInvalid="keep").transform(prepared)
    return fx.tfidf(prepared, "_words", vocab, "raw_features", numbers)


def prepared_vectors(df: DataFrame, keep: list[str], cfg: QcConfig, folds: int = 0) -> tuple[DataFrame, DataFrame | None]:
    """Columns to keep and ``raw_features`` of all rows, in a form that is stored, and the vocabulary. With ``folds`` the rows are dealt out to them first.

    The first of the columns to keep names the row, the second its label. Only what vectors are made of is written on the way.
    """
    prepared, numbers = feature_columns(df, cfg)
    prepared = prepared.select(*keep, *numbers, *(["_words"] if cfg.use_text else []))
    if folds:
        prepared, keep = fx.stratified_folds(prepared, *keep[:2], folds, cfg.seed), [*keep, "fold"]
    prepared = cut_lineage(prepared, "prepared", compression="zstd")  # masked texts are read several times
    vocab = vocabulary(prepared, cfg)
    if vocab is None:
        return cut_lineage(assemble_features(prepared, numbers, None).select(*keep, "raw_features"), "vectors"), None
    return fx.stored_tfidf(prepared, "_words", vocab, "raw_features", numbers, keep), vocab


def classifier(cfg: QcConfig, seed: int) -> Pipeline:
    """Scaling by standard deviation without centring, then the chosen trees.

    ``lgbm`` and ``xgb`` name boosted trees, anything else a forest; ``xgb`` trains without class weights.
    """
    scaler = StandardScaler(withMean=False, withStd=True, inputCol="raw_features", outputCol="features")
    common = {"labelCol": cfg.label_col, "featuresCol": "features", "seed": seed}
    if cfg.model in {"lgbm", "xgb"}:
        settings = {
            "boosted": True, "numTrees": cfg.rounds, "stepSize": 0.05, "maxDepth": 5 if cfg.model == "lgbm" else 6, "subsamplingRate": 0.9,
            "featureSubsetStrategy": "0.8", "minInstancesPerNode": 20 if cfg.model == "lgbm" else 1, "weightCol": "weight" if cfg.model == "lgbm" else None,
        }
    else:
        settings = {"boosted": False, "numTrees": cfg.trees, "maxDepth": cfg.forest_depth, "weightCol": "weight"}
    trees = SparseTrees(**{**settings, **common, **cfg.extra})
    return Pipeline(stages=[scaler, trees])


def weighted(df: DataFrame, label: str) -> DataFrame:
    # One row per class: the broadcast has a fixed bound.
    return df.join(F.broadcast(fx.class_weights(df, label).select(label, "weight")), label)


def positive_proba(scored: DataFrame) -> DataFrame:
    return scored.withColumnRenamed("probability", "qc_proba_ad").drop("features")


def fit_folds(vectors: DataFrame, cfg: QcConfig, folds: int, at_once: int = 2) -> list[PipelineModel]:
    """One model per fold, each from the rows of the other folds, some side by side: a fit leaves cores idle between its steps."""

    def fit(k: int) -> PipelineModel:
        return classifier(cfg, cfg.seed + k + 1).fit(weighted(vectors.where(F.col("fold") != k), cfg.label_col))

    with ThreadPool(min(at_once, folds)) as pool:
        return pool.map(inheritable_thread_target(vectors.sparkSession)(fit), range(folds))


def oof_predict(vectors: DataFrame, id_col: str, cfg: QcConfig, folds: int) -> DataFrame:
    """Score of each row by a model that did not see its fold. ``vectors``, a stored table, has raw_features and fold."""
    out = None
    for k, model in enumerate(fit_folds(vectors, cfg, folds)):
        part = positive_proba(model.transform(vectors.where(F.col("fold") == k)))
        out = part if out is None else out.unionByName(part)
    return out.select(id_col, cfg.label_col, "fold", "qc_proba_ad")


def score_report(scored: DataFrame, label: str, name: str) -> DataFrame:
    """One row of metrics at the threshold with the best F1."""
    best = best_f1_threshold(scored, label, "qc_proba_ad").select("threshold")
    at_best = confusion_metrics(scored, label, "qc_proba_ad", best.scalar())
    return at_best.select(
        F.lit(name).alias("part"), "precision", "recall", "f1", "accuracy",
        average_precision(scored, label, "qc_proba_ad").scalar().alias("average_precision"),
        roc_auc(scored, label, "qc_proba_ad").scalar().alias("roc_auc"),
        best.scalar().alias("threshold"),
    )
