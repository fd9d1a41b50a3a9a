"""Fitted pipelines: persistence, probabilities, search and the whole run on the smallest tables."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import feature_names
from tracklab.operators import infer, models, tuning
from tracklab.operators.boosting import JointBoosting, JointBoostingModel
from tracklab.operators.knn import KnnClassifier, KnnModel
from tracklab.operators.metrics import confusion, metric_row
from tracklab.operators.small import literal_table
from tracklab.operators.stages import OutlierFenceModel, PopStdScaler, preprocessor, scaled_names
from tracklab.plans import evaluation, queries_train, training
from tracklab.plans.catalogue import ORACLES, QUERIES
from tracklab.plans.queries_train import TARGET, IDS, _pipeline, _prepared, _search_rows
from tracklab.sources import files
from tracklab.sources.artefacts import files_print, kept
from tracklab.sources.tables import tracks


@pytest.fixture(scope="module")
def prepared(spark, sf):
    return _prepared(spark, sf)


@pytest.fixture(scope="module")
def pipeline(spark, sf):
    return _pipeline(spark, sf)


def test_split_table_expectations(prepared):
    n = prepared.rows.count()
    by = {(r["split"], r["signal_genre"]): r["count"] for r in prepared.rows.groupBy("split", "signal_genre").count().collect()}
    size = {s: sum(v for (t, _), v in by.items() if t == s) for s in ("train", "val", "test")}
    assert 0.68 <= size["train"] / n <= 0.72
    assert 0.13 <= size["test"] / n <= 0.17
    for c in prepared.labels:
        assert abs(by[("train", c)] / size["train"] - by[("test", c)] / size["test"]) <= 0.03
    assert prepared.labels == S.CLASSES


def test_scaled_features_are_finite_and_42_wide(prepared):
    x = prepared.rows.select(vector_to_array("features").alias("x"))
    bad = x.filter(F.exists("x", lambda v: F.isnan(v) | v.isNull() | (F.abs(v) == float("inf"))))
    assert bad.count() == 0
    assert x.select(F.size("x")).distinct().collect() == [(42,)]


def test_scaler_keeps_constant_columns(spark):
    df = literal_table(spark, [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    model = PopStdScaler(inputCols=["a", "b"], outputCols=["za", "zb"]).fit(df)
    got = model.transform(df).collect()
    assert [r["za"] for r in got] == pytest.approx([-1.5 ** 0.5, 0, 1.5 ** 0.5])
    assert [r["zb"] for r in got] == [0.0, 0.0, 0.0]


def test_preprocessor_round_trip(spark, sf, prepared, tmp_path):
    path = str(tmp_path / "pre")
    prepared.preprocessor.write().overwrite().save(path)
    again = PipelineModel.load(path)
    t = tracks(spark, sf).limit(20)
    a, b = (m.transform(t).orderBy("track_id").select("features").collect() for m in (prepared.preprocessor, again))
    assert a == b and len(again.stages) == 4


def test_clipping_preprocessor(spark, sf, tmp_path):
    t = tracks(spark, sf)
    fitted = preprocessor(clip=True).fit(t)
    assert isinstance(fitted.stages[1], OutlierFenceModel)
    top = fitted.stages[1].limits()["duration_ms"][1]
    assert fitted.transform(t).agg(F.max("duration_ms")).first()[0] == top
    fitted.write().save(str(tmp_path / "clip"))
    assert PipelineModel.load(str(tmp_path / "clip")).stages[1].limits() == fitted.stages[1].limits()


@pytest.fixture(scope="module")
def sample(spark):
    """Records spread evenly over each feature's valid range, every feature in an order of its own."""
    n, rng = 64, np.random.default_rng(7)
    columns = []
    for c in S.FEATURES:
        low, high, _ = S.FEATURE_DOMAIN[c]
        even = np.linspace(low, high, n)
        columns.append(rng.permutation(np.round(even) if c in S.DISCRETE_FEATURES else even))
    return literal_table(spark, [(i, *map(float, r)) for i, r in enumerate(zip(*columns))],
                         "i int, " + ", ".join(f"`{c}` double" for c in S.FEATURES))


def test_predictions_are_known_classes(sample, pipeline):
    labels = [r[0] for r in infer.predict(sample, pipeline).collect()]
    assert len(labels) == 64 and set(labels) <= set(S.CLASSES)
    codes = [r[0] for r in infer.predict(sample, pipeline, decode=False).collect()]
    assert [S.CLASSES[c] for c in codes] == labels


def test_probabilities(sample, pipeline):
    wide = infer.predict_proba(sample, pipeline, keep=["i"])
    assert wide.columns == ["i", *S.CLASSES]
    p = np.array([r[1:] for r in wide.collect()])
    assert p.shape == (64, 6) and np.allclose(p.sum(axis=1), 1, atol=1e-5)
    ranked = infer.ranked_classes(sample, pipeline, ["i"]).collect()
    assert len(ranked) == 64 * 6
    assert all(r["rank"] in range(1, 7) for r in ranked)


def test_batch_scoring_keeps_input_and_fills(sample, pipeline):
    out = infer.score_batch(sample.drop("tempo"), pipeline)
    assert out.columns == ["i", *[c for c in S.FEATURES if c != "tempo"], "tempo", "predicted_genre", "confidence"]
    rows = out.collect()
    assert len(rows) == 64 and all(r["tempo"] == 0 and 0 < r["confidence"] <= 100 for r in rows)
    assert all(round(r["confidence"], 1) == r["confidence"] for r in rows)


def test_model_without_probabilities(sample, prepared):
    svm = models.candidate_models(1000, 6, svm_steps=3)["SVM"].fit(prepared.rows.filter("split = 'val'"))
    scoring = infer.bundle(prepared.preprocessor, svm, models.label_decoder(prepared.labels))
    assert "confidence" not in infer.score_batch(sample, scoring).columns
    with pytest.raises(AttributeError):
        infer.predict_proba(sample, scoring)


def test_boosting_round_trip(prepared, tmp_path):
    train = prepared.rows.filter("split = 'val'")
    model = JointBoosting(maxIter=3, maxDepth=3).fit(train)
    test = prepared.rows.filter("split = 'test'").orderBy("track_id").limit(10)
    model.save(str(tmp_path / "gbt"))
    again = JointBoostingModel.load(str(tmp_path / "gbt"))
    a, b = (m.transform(test).select("prediction", "probability").collect() for m in (model, again))
    assert a == b
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in a)
    assert all(r["probability"].argmax() == r["prediction"] for r in a)
    importance = models.split_counts(test.sparkSession, model).collect()
    assert len(importance) == 42 and sum(r["importance"] for r in importance) > 0


def test_knn_model(prepared, tmp_path):
    train = prepared.rows.filter("split = 'train'")
    test = prepared.rows.filter("split = 'test'")
    model = KnnClassifier(k=7).fit(train)
    scored = model.transform(test)
    assert scored.count() == test.count()
    assert scored.filter("prediction = label").count() / test.count() > 0.7
    model.save(str(tmp_path / "knn"))
    assert KnnModel.load(str(tmp_path / "knn")).transform(test.limit(5)).count() == 5


def test_forest_quality(prepared):
    forest = RandomForestClassifier(numTrees=10, maxDepth=8, seed=S.SEED)
    fitted = models.fit_final(forest, prepared.rows, include_validation=False)
    test = prepared.rows.filter("split = 'test'")
    assert fitted.transform(test).filter("prediction = label").count() / test.count() > 0.9


def test_tuned_model_factory():
    boosted = models.tuned_model("Gradient Boosting", {"num_leaves": 63, "learning_rate": 0.05, "colsample_bytree": 0.8}, 6)
    get = boosted.getOrDefault
    assert (boosted.getMaxIter(), get("numLeaves"), get("maxDepth"), get("subsamplingRate"), get("columnsRate")) == (1000, 63, 0, 0.8, 0.8)
    full = models.boosting_from({"num_leaves": 127, "max_depth": 3, "reg_alpha": 0.5, "reg_lambda": 2.0, "min_child_samples": 7})
    assert [full.getOrDefault(p) for p in ("maxDepth", "regAlpha", "regLambda", "minInstancesPerNode")] == [3, 0.5, 2.0, 7]
    mlp = models.tuned_model("MLP", {"n_layers": 2, "n_units_l0": 70, "n_units_l1": 80, "lr_init": 0.02, "alpha": 0.3}, 6)
    assert [mlp.getOrDefault(p) for p in ("hidden", "maxIter", "stepSize", "penalty")] == [[70, 80], 300, 0.02, 0.3]
    forest = models.tuned_model("Random Forest", {"n_estimators": 150, "max_depth": 10, "max_features": "log2"}, 6)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (150, 10, "log2")
    with pytest.raises(ValueError):
        models.tuned_model("KNN", {}, 6)


def test_search_space():
    drawn = tuning.sample_params("Boosting", 50)
    assert drawn == tuning.sample_params("Boosting", 50)
    for p in drawn:
        assert 0.02 <= p["learning_rate"] <= 0.3 and 31 <= p["num_leaves"] <= 127
    with pytest.raises(ValueError):
        tuning.grid_search("SVM", None, 6, 42)
    with pytest.raises(ValueError):
        tuning.random_search("KNN", None, 6, 42)


def test_grid_search_returns_best_trial(spark, sf):
    rows = _search_rows(spark, sf)
    best, score, trials = tuning.grid_search(
        "Random Forest", rows, 6, 42, grid={"max_depth": [2, 8]}, fixed={"n_estimators": 5})
    assert best == {"n_estimators": 5, "max_depth": 8} and score == max(s for _, s in trials)
    history = tuning.trial_history(spark, trials, 0.1).orderBy("trial").collect()
    assert history[-1]["best"] == score and history[-1]["improvement"] == pytest.approx(score - 0.1)


def test_sequential_search(spark, sf, monkeypatch):
    monkeypatch.setitem(tuning.RANGES, "Random Forest", {"n_estimators": ("int", 2, 5), "max_depth": ("int", 1, 8)})
    rows = _search_rows(spark, sf)
    best, score, trials = tuning.sequential_search("Random Forest", rows, trials=13)
    assert len(trials) == 13 and score == max(s for _, s in trials) and (best, score) in trials
    assert trials == tuning.sequential_search("Random Forest", rows, trials=13)[2]
    with pytest.raises(ValueError):
        tuning.sequential_search("SVM", rows)


def test_fold_metrics_equal_the_tables(spark, prepared):
    scored = prepared.rows.filter("split = 'test'").select("label", F.when(F.col("label") < 3, 1.0).otherwise(F.col("label")).alias("prediction"))
    row = metric_row(confusion(scored, "label", "prediction")).first()
    counts = [tuple(r) for r in scored.groupBy("label", "prediction").count().collect()]
    assert tuning.fold_metrics(counts) == pytest.approx((row["accuracy"], row["weighted_f1"]))
    assert tuning.fold_metrics([]) == (0.0, 0.0)


def test_kept_artefacts_are_made_once(spark, tmp_path):
    made = []

    def make(folder):
        made.append(folder)
        spark.range(3).write.parquet(folder)

    key = [str(tmp_path), 1]
    folders = {kept(spark, "test", key, make) for _ in range(3)}
    assert len(made) == 1 and folders == set(made) and spark.read.parquet(made[0]).count() == 3
    assert kept(spark, "test", [*key, 2], make) != made[0] and len(made) == 2
    spark.range(5).write.parquet(str(tmp_path / "t"))
    before = files_print(spark, [str(tmp_path / "t")])
    assert before == files_print(spark, [str(tmp_path / "t")])
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t"))
    assert before != files_print(spark, [str(tmp_path / "t")])


def test_whole_run(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(training.M, "candidate_models", lambda n, k, w, r: {
        "Random Forest": RandomForestClassifier(numTrees=5, maxDepth=6, seed=1), "KNN": KnnClassifier(k=7)})
    monkeypatch.setitem(tuning.RANGES, "Random Forest", {"n_estimators": ("int", 4, 6), "max_depth": ("int", 6, 8)})
    out = str(tmp_path)
    t = tracks(spark, sf)
    training.train(t, S.TARGET, IDS, out, trials=2)
    report = spark.read.parquet(f"{out}/model_selection")
    assert {r["section"] for r in report.collect()} == {"ranking", "improvement", "parameter"}
    assert {r["split"] for r in files.read_split(spark, f"{out}/splits", ["train", "val"]).select("split").distinct().collect()} == {"train", "val"}
    scoring = PipelineModel.load(f"{out}/model")
    tables = evaluation.evaluate(t.limit(300).filter("track_genre IS NOT NULL").drop("signal_genre"), scoring, S.TARGET, f"{out}/reports")
    assert tables["metrics"].count() == 1
    assert spark.read.parquet(f"{out}/reports/improvement_log").count() == 1


def test_unlisted_queries_run(spark, sf):
    for name in ("predict_labels", "ranked_classes", "split_importance", "test_set_evaluation", "boosting_predict"):
        assert name not in ORACLES
        assert QUERIES[name](spark, sf).count() > 0


def test_feature_list_matches_scaled_names():
    assert scaled_names() == [f"z_{c}" for c in feature_names()]


def test_registered_searches_do_the_whole_job(spark, sf, monkeypatch, tmp_path):
    fits = []

    def made(spark, purpose, key, make):
        folder = str(tmp_path / f"{purpose}-{len(list(tmp_path.iterdir()))}")
        make(folder)
        return folder

    monkeypatch.setattr(queries_train, "kept", made)

    def scores(estimators, df, *args, **kwargs):
        fits.append(list(estimators))
        return [(i / 100, i / 100, 1.0) for i in range(len(fits[-1]))]

    monkeypatch.setattr(tuning, "cross_validate", scores)
    names = list(models.candidate_models(1000, 6))
    assert [r["model"] for r in QUERIES["cv_comparison"](spark, sf).collect()] == names[::-1]
    assert [r["model"] for r in QUERIES["best_model"](spark, sf).collect()] == names[-1:]
    for compared in map(lambda f: dict(zip(names, f)), fits):
        assert compared["Gradient Boosting"].getMaxIter() == 200 and compared["SVM"].getMaxIter() == 2000
    assert QUERIES["grid_search"](spark, sf).count() == 18 and {e.getNumTrees() for e in fits[-1]} == {150}
    drawn = tuning.sample_params("Random Forest")
    assert QUERIES["random_search"](spark, sf).count() == len(drawn) == 50
    assert [(e.getNumTrees(), e.getMaxDepth()) for e in fits[-1]] == [(p["n_estimators"], p["max_depth"]) for p in drawn]


def test_registered_boosting_has_all_rounds(spark, sf, monkeypatch):
    def fit(self, rows):
        raise StopIteration(self.getMaxIter())

    monkeypatch.setattr(JointBoosting, "_fit", fit)
    with pytest.raises(StopIteration, match="^200$"):
        QUERIES["boosting_predict"](spark, sf)


def test_scoring_uses_the_full_forest(pipeline):
    forest = pipeline.stages[-2]
    assert (forest.getNumTrees, forest.getOrDefault("maxDepth")) == (100, models.DEEPEST_TREE)
