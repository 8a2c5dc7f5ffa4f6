import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from postsieve.operators import sparsetrees
from postsieve.operators.qcmodel import QcConfig
from postsieve.operators.sparsetrees import SparseTrees
from postsieve.plans import jobs
from postsieve.sources import store

CFG = QcConfig(model="rf", max_features=50, trees=5, forest_depth=4, n_splits=3, min_df=2)


@pytest.fixture(scope="module")
def posts(spark):
    ad = F.col("id") % 3 == 0
    text = F.when(ad, F.concat(F.lit("오늘만 특가 세일 "), F.col("id"))).otherwise(F.concat(F.lit("조용한 동네 밥집 "), F.col("id")))
    return spark.range(60).select(F.col("id").alias("ingest_seq"), text.alias("content"), ad.cast("int").alias("is_ad"), F.col("id").cast("string").alias("likes"))


def test_train_and_check(spark, posts, tmp_path):
    scored, report = jobs.qc_train(spark, posts, "ingest_seq", str(tmp_path / "m"), CFG)
    assert scored.count() == 60 and scored.select("ingest_seq").distinct().count() == 60
    rows = {r["part"]: r for r in report.collect()}
    assert set(rows) == {"oof", "fold 1", "fold 2", "fold 3"} and rows["oof"]["roc_auc"] > 0.95
    nonads = posts.where("is_ad = 0")
    summary = jobs.qc_check(spark, nonads, str(tmp_path / "m"), str(tmp_path / "out"), CFG).first()
    assert summary["nonads"] == 40 and summary["suspects"] == store.read_table(spark, str(tmp_path / "out/suspects")).count()
    empty = jobs.qc_check(spark, nonads.where("false"), str(tmp_path / "m"), str(tmp_path / "out"), CFG).first()
    assert (empty["nonads"], empty["suspects"], empty["borderline"], empty["avg_proba"]) == (0, 0, 0, None)
    meta = spark.read.json(str(tmp_path / "m/meta")).first()
    assert meta["model"] == "rf" and meta["max_features"] == 50


def test_one_class_is_refused(spark, posts, tmp_path):
    with pytest.raises(ValueError, match="two classes"):
        jobs.qc_train(spark, posts.where("is_ad = 1"), "ingest_seq", str(tmp_path), CFG)


def made_rows(spark, n=400):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(n):
        at = np.sort(draw.choice(40, 12, replace=False))
        value = draw.integers(-3, 6, 12).astype(float)
        seen = dict(zip(at.tolist(), value.tolist(), strict=True))
        y = float(seen.get(3, 0) + seen.get(7, 0) - seen.get(11, 0) + draw.normal() > 1)
        rows.append((i, y, 1.0 + i % 3, Vectors.sparse(40, at.tolist(), value.tolist())))
    return spark.createDataFrame(rows, ["id", "y", "weight", "features"]).repartition(3).localCheckpoint()


@pytest.mark.parametrize("block,portion", [(1 << 20, 4 << 20), (50, 64)])
def test_sparse_tree_is_that_of_spark(spark, monkeypatch, block, portion):
    """Few distinct values: both cut between all of them, so a single tree on all rows and features is the same.

    It is held against a regression on the labels, since Spark merges leaves of a class vote and so loses shares.
    """
    monkeypatch.setattr(sparsetrees, "CELLS", portion)
    monkeypatch.setattr(sparsetrees, "ENTRIES", block)
    monkeypatch.setattr(sparsetrees, "RANGE", 7)
    rows = made_rows(spark)
    settings = {"labelCol": "y", "featuresCol": "features", "weightCol": "weight", "seed": 1, "maxDepth": 4, "minInstancesPerNode": 5}
    mine = SparseTrees(boosted=False, numTrees=1, **settings).fit(rows).transform(rows)
    theirs = DecisionTreeRegressor(**settings).fit(rows).transform(rows)
    a = {r["id"]: r["probability"] for r in mine.collect()}
    b = {r["id"]: r["prediction"] for r in theirs.collect()}
    assert a == pytest.approx(b) and len(set(a.values())) > 8


def test_sparse_trees_boosted_saved_and_loaded(spark, tmp_path):
    rows = made_rows(spark)
    settings = {"labelCol": "y", "featuresCol": "features", "seed": 1, "maxDepth": 3}
    model = Pipeline(stages=[SparseTrees(boosted=True, numTrees=4, **settings)]).fit(rows)
    spark_model = GBTClassifier(maxIter=4, stepSize=0.1, **settings).fit(rows)
    mine = {r["id"]: r["probability"] for r in model.transform(rows).collect()}
    theirs = {r["id"]: r["probability"][1] for r in spark_model.transform(rows).collect()}
    assert mine == pytest.approx(theirs)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(rows)
    assert {r["id"]: r["probability"] for r in again.collect()} == mine


def test_sparse_trees_keep_only_entries(spark):
    """Blocks of rows with few of very many features stay small: a dense row of bins would have 200,000 bytes at least."""
    rows = spark.range(200).selectExpr("cast(id % 2 as double) label", "1.0d weight", "array(cast(id * 900 as int)) indices", "array(double(1)) values")
    bins = sparsetrees.cut_bins(rows, 200, 200_000, 32, 1)
    blocks = sparsetrees.binned(rows, bins).selectExpr("length(label) / 8 n", "length(present) + length(starts) + length(rows) + length(bins) size").collect()
    assert sum(r["n"] for r in blocks) == 200 and sum(r["size"] for r in blocks) < 200 * 20


def test_sparse_trees_refuse_other_labels(spark):
    rows = made_rows(spark, 30).withColumn("y", F.col("y") + 1)
    with pytest.raises(ValueError, match="labels 0 and 1"):
        SparseTrees("y", "features", 1, False, 2, 2).fit(rows)


def test_shares_of_a_forest_stay_between_0_and_1(spark):
    """Sums of uneven weights are rounded: the right side is what the left leaves of its node."""
    rows = made_rows(spark).withColumn("weight", 0.1 + F.col("id") % 7 / 3)
    model = SparseTrees("y", "features", 5, False, 12, 6, weightCol="weight").fit(rows)
    values = [v for t in model.trees for v in t.value.values()]
    assert len(values) > 300 and min(values) >= 0 and max(values) <= 1


@pytest.mark.parametrize("boosted,few", [(True, False), (False, True), (False, False)])
def test_trees_of_one_task_are_those_of_jobs_for_each_level(spark, monkeypatch, boosted, few):
    """Rows that a task holds give the trees that the level by level jobs give, negative values, draws and chosen features alike (F6)."""
    monkeypatch.setattr(sparsetrees, "ENTRIES", 900)
    rows = made_rows(spark)
    strategy = "3" if few else "0.6"
    settings = {"featureSubsetStrategy": strategy, "subsamplingRate": 0.8, "minInstancesPerNode": 15, "weightCol": "weight"}
    model = SparseTrees("y", "features", 5, boosted, 6, 5, **settings).fit(rows)
    monkeypatch.setattr(sparsetrees, "HELD", 0)
    other = SparseTrees("y", "features", 5, boosted, 6, 5, **settings).fit(rows)
    for a, b in zip(model.trees, other.trees, strict=True):
        assert a.split == b.split and a.value == pytest.approx(b.value) and a.weight == b.weight  # nodes are large enough not to tie
    assert sum(len(t.split) for t in model.trees) > 20


def test_classifier_query_fits_models_of_full_size(spark, monkeypatch):
    """Each kind with as many trees, rounds and levels as the job has by default, on all rows (F6)."""
    from postsieve.catalog import quality

    fitted = []

    class Fitted:
        def fit(self, rows):
            fitted.append(rows.count())
            return self

        def transform(self, rows):
            return rows.withColumns({"probability": F.lit(0.5), "features": F.lit(0)})

    rows = made_rows(spark, 30).select(F.col("id").alias("ingest_seq"), F.col("y").cast("int").alias("label"), F.col("features").alias("raw_features"))
    configs = []
    monkeypatch.setattr(quality, "vectors", lambda *a: rows)
    monkeypatch.setattr(quality.qc, "classifier", lambda cfg, seed: (configs.append(cfg), Fitted())[1])
    assert quality.classifier(None).where("in_range").groupBy("kind").count().count() == 3 and fitted == [30] * 3
    assert sorted(c.model for c in configs) == ["lgbm", "rf", "xgb"]
    full = QcConfig()
    for c in configs:
        assert (c.trees, c.forest_depth, c.rounds, c.max_features, c.min_df, c.extra) == (full.trees, full.forest_depth, full.rounds, full.max_features, full.min_df, {})


def test_stored_vectors_are_those_made_at_once(spark):
    """Gaps and counts give the same vectors, take a fraction of their bytes, and a filter reaches what is stored (F1)."""
    from postsieve.operators import features as fx
    from postsieve.operators.termvectors import with_counts

    texts = [f" {' '.join(f'word{(i * k) % 37:03d}' for k in range(1, 60))} " for i in range(40)] + [" ", None]
    df = spark.createDataFrame([(i, i % 5, t, float(i) if i % 3 else None) for i, t in enumerate(texts)], "id int, fold int, w string, x double")
    vocab = fx.with_idf(fx.vocab_top_k(df, "w", 2, 200), df.count())
    once = fx.tfidf(df, "w", vocab, "v", ["x"]).select("id", "fold", "v")
    stored = fx.stored_tfidf(df, "w", vocab, "v", ["x"], ["id", "fold"])
    assert sorted(map(str, once.collect())) == sorted(map(str, stored.collect()))
    kept = with_counts(df, "w", [r["term"] for r in vocab.orderBy("position").collect()], fx.GRAM_SIZES, ["id"])
    sizes = kept.selectExpr("sum(length(_gaps) + length(_counts)) bytes", "sum(_terms) entries").first()
    assert sizes["bytes"] <= 4 * sizes["entries"]
    plan = stored.where("fold = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(fold), EqualTo(fold,1)]" in plan


def test_fits_leave_no_blocks_and_no_setting_behind(spark, tmp_path):
    """Blocks of a fit, as large as its rows, are deleted when it ends (F1)."""
    from pathlib import Path

    from postsieve.session import ARROW_ROWS, shared_dir

    before, setting = set(Path(shared_dir(spark)).glob("blocks-*")), spark.conf.get(ARROW_ROWS)
    SparseTrees("y", "features", 5, False, 2, 2).fit(made_rows(spark, 30))
    assert set(Path(shared_dir(spark)).glob("blocks-*")) == before and spark.conf.get(ARROW_ROWS) == setting
