import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from latewatch.ml import features as ml_features
from latewatch.ml import models as ml_models
from latewatch.operators import buckets, metrics
from latewatch.plans import jobs
from latewatch.session import partition_report


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        label = int(rng.random() < 0.3)
        score = round(min(max(rng.gauss(0.3 + 0.3 * label, 0.2), 0.0), 1.0), 2)  # many ties
        rows.append((i, label, score, float(score >= 0.5)))
    return spark.createDataFrame(rows, "id int, label int, score double, prediction double")


def test_classification_scores_equal_the_evaluators(judged):
    ours = metrics.classification_scores(judged, "label", "prediction").first()

    def theirs(name, **options):
        return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name, **options).evaluate(judged)

    assert ours.accuracy == pytest.approx(theirs("accuracy"), abs=1e-9)
    assert ours.precision_breakdown == pytest.approx(theirs("precisionByLabel", metricLabel=1.0), abs=1e-9)
    assert ours.recall_breakdown == pytest.approx(theirs("recallByLabel", metricLabel=1.0), abs=1e-9)
    assert ours.f1_breakdown == pytest.approx(theirs("fMeasureByLabel", metricLabel=1.0), abs=1e-9)
    assert ours.f1_weighted == pytest.approx(theirs("f1"), abs=1e-9)


def test_areas_equal_the_evaluator(judged):
    ours = metrics.area_under_curves(judged, "label", "score").first()
    for name, value in (("areaUnderROC", ours.roc_auc), ("areaUnderPR", ours.pr_auc)):
        evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", metricName=name, numBins=0)
        assert value == pytest.approx(evaluator.evaluate(judged), abs=1e-9)


def test_curve_and_matrix_account_for_every_row(judged):
    curve = metrics.roc_curve(judged, "label", "score").orderBy("fp", "tp").collect()
    assert (curve[0].tpr, curve[0].fpr) == (0, 0) and (curve[-1].tpr, curve[-1].fpr) == (1, 1)
    cells = metrics.confusion_matrix(judged, "label", "prediction").collect()
    assert sum(r.predicted_0 + r.predicted_1 for r in cells) == judged.count()


def test_regression_scores_equal_the_evaluator(judged):
    ours = metrics.regression_scores(judged, "label", "score").first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="label", predictionCol="score", metricName=name).evaluate(
            judged.withColumn("label", F.col("label").cast("double"))
        )
        assert ours[name] == pytest.approx(theirs, abs=1e-9)


def test_weights_of_a_missing_class_are_missing(spark):
    df = spark.createDataFrame([(0,), (0,)], "is_breakdown int")
    row = buckets.class_weight_row(df).first()
    assert row.w_pos is None and row.w_neg == 0.5


def test_confusion_matrix_has_a_row_for_every_class(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (0, 0.0)], "label int, prediction double")
    assert [tuple(r) for r in metrics.confusion_matrix(df, "label", "prediction").collect()] == [(0, 2, 1), (1, 0, 0)]


def test_rare_values_become_other(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "operator string")
    got = {r.operator: r.operator_bucketed for r in buckets.bucket_rare(df, top=2).collect()}
    assert got == {"a": "a", "b": "b", "c": "OTHER", None: "OTHER"}


def test_any_number_of_levels_is_indexed(spark):
    rows = spark.range(100_000).select((F.col("id") % 50_000).cast("string").alias("c"), F.lit("x").alias("d"))
    rows = rows.unionByName(spark.createDataFrame([("7", None), (None, "x")], "c string, d string"))
    levels = ml_features.level_table(rows, ["c", "d"])
    assert levels.filter("column_name = 'c'").count() == 50_000
    found = ml_features.with_level_index(rows, levels, ["c", "d"])
    by_value = {r.c: r.c_idx for r in found.select("c", "c_idx").distinct().collect()}
    order = sorted((str(k) for k in range(50_000)), key=lambda v: (v != "7", v))
    assert all(by_value[v] == k for k, v in enumerate(order)) and by_value[None] == 50_000
    assert {(r.d, r.d_idx) for r in found.select("d", "d_idx").distinct().collect()} == {("x", 0.0), (None, 1.0)}


def test_slots_are_named_after_levels_and_columns(spark):
    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), ("a", "y", 3.0)], "p string, q string, n double")
    features = ml_features.FeatureSet(("p", "q"), ("n",), "n", False)
    fitted = ml_features.feature_pipeline(features).fit(rows)
    names = ml_features.slot_names(fitted)
    assert names == ["p_oh_a", "p_oh_b", "q_oh_x", "q_oh_y", "n"]
    assert {len(r.features) for r in fitted.transform(rows).collect()} == {5}


def test_classification_job(spark, incidents, tmp_path):
    # Breakdowns depend on the hour here, so that there is something to learn.
    planted = incidents.withColumn("is_breakdown", (F.col("hour") % 2).cast("int"))
    chosen = ml_models.classifiers(iterations=5, trees=5, depth=5, rounds=5, round_depth=4)
    chosen.pop("LogisticRegression")
    document = jobs.classification(planted, str(tmp_path), tune=False, estimators=chosen)
    assert sum(sum(v for k, v in row.items() if k != "label") for row in document["confusion_matrix"]) > 0
    assert sum(document["label_balance"].values()) == incidents.count()
    for points in document["roc"].values():
        assert points == sorted(points, key=lambda p: (p["fpr"], p["tpr"])) and points[-1] == {"fpr": 1.0, "tpr": 1.0}
    assert {r["model"] for r in document["results"]} == {"RandomForest", "GBTClassifier"}
    assert max(r["roc_auc"] for r in document["results"]) > 0.7
    whole = PipelineModel.load(f"{tmp_path}/model_{document['best_model']}")
    assert whole.transform(ml_features.prepare_risk(planted)).select("prediction").count() == planted.count()
    assert (tmp_path / "classification_metrics.json").exists()


def test_tuning_reports_every_setting(spark, incidents):
    prepared = ml_features.prepare_risk(incidents)
    fitted, summary = ml_models.tune_logistic(prepared, (0.0, 0.1), (0.0,), folds=2, iterations=3)
    assert len(summary["settings"]) == 2
    assert fitted.transform(prepared).select("prediction").count() == prepared.count()
    assert summary["best_cv_roc_auc"] == max(s["roc_auc"] for s in summary["settings"])


def test_settings_without_a_penalty_are_fitted_once(spark, incidents, monkeypatch):
    fits = []
    fit = ml_models.LogisticRegression.fit

    def counted(self, rows, params=None):
        fits.append(params)
        return fit(self, rows, params)

    monkeypatch.setattr(ml_models.LogisticRegression, "fit", counted)
    _, summary = ml_models.tune_logistic(ml_features.prepare_risk(incidents), (0.0, 0.1), (0.0, 0.5), folds=2, iterations=3)
    assert [(s["regParam"], s["elasticNetParam"]) for s in summary["settings"]] == [(0.0, 0.0), (0.0, 0.5), (0.1, 0.0), (0.1, 0.5)]
    assert summary["settings"][0]["roc_auc"] == summary["settings"][1]["roc_auc"]
    assert len(fits) == 2 * 3 + 1


def test_models_score_in_a_session_that_observed_rows(spark, incidents):
    observed = Observation("rows")
    spark.range(5).observe(observed, F.count("*").alias("n")).collect()
    assert observed.get["n"] == 5
    chosen = ml_models.classifiers(iterations=2, trees=2, depth=2, rounds=2, round_depth=2)
    outcome = ml_models.compare_classifiers(ml_features.prepare_risk(incidents), chosen)
    assert [r["model"] for r in outcome.results] == ["LogisticRegression", "RandomForest", "GBTClassifier"]
    assert all(0 <= r["roc_auc"] <= 1 for r in outcome.results)
    _, summary = ml_models.tune_logistic(ml_features.prepare_risk(incidents), (0.1,), (0.0,), folds=2, iterations=2)
    assert len(summary["settings"]) == 1


def test_training_tasks_do_not_grow_with_the_rows(spark, incidents):
    used = ["busbreakdown_id", *ml_features.BREAKDOWN_RISK.categorical, *ml_features.BREAKDOWN_RISK.numeric]
    rows = ml_features.prepare_risk(incidents).select(*used).coalesce(1)
    n = rows.count()
    dealt = ml_models.balanced(rows, ml_features.BREAKDOWN_RISK, most=100)
    sizes = [r.rows for r in partition_report(dealt).collect()]
    assert sum(sizes) == n and len(sizes) >= n // 100 and max(sizes) < 200
    assert dealt.exceptAll(rows).isEmpty()
    assert ml_models.balanced(rows, ml_features.BREAKDOWN_RISK, most=n) is rows


def test_forests_keep_the_nodes_of_rows(spark):
    forests = ml_models.classifiers()["RandomForest"], ml_models.regressors()["Random Forest"]
    assert all(f.getCacheNodeIds() and f.getCheckpointInterval() == -1 for f in forests)


def test_regression_job(spark, incidents, tmp_path):
    chosen = {"Decision Tree": ml_models.regressors(depth=4)["Decision Tree"]}
    document = jobs.regression(incidents, str(tmp_path), sample=0.5, estimators=chosen)
    assert document["best_model"] == "Decision Tree" and len(document["feature_importances"]) == 12
    importances = [f["importance"] for f in document["feature_importances"]]
    assert importances == sorted(importances, reverse=True)
    from latewatch.sources.readers import read_document, read_predictions

    sample = read_predictions(spark, f"{tmp_path}/predictions.csv").first()
    assert sample.residual == pytest.approx(sample.actual - sample.prediction)
    assert read_document(spark, f"{tmp_path}/regression_metrics.json").first().best_model == "Decision Tree"
    assert read_document(spark, f"{tmp_path}/nothing.json") is None
