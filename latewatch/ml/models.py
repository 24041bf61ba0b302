"""Estimators, training with timing, tuning and scoring."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.ml.features import BREAKDOWN_RISK, DELAY_MINUTES, FeatureSet, feature_pipeline, slot_names
from latewatch.operators import metrics
from latewatch.operators.split import hash_split, with_folds
from latewatch.session import cached, ensure_checkpoint_dir, partition_report

# The tuning grid.
REGULARISATION = (0.0, 0.01, 0.1)
ELASTIC_MIX = (0.0, 0.5)
# Settings fitted side by side: a pass of one leaves cores idle, but each holds the rows of its fold once more.
SIDE_BY_SIDE = 2
# Tree learners collect statistics of as many nodes per pass as fit this much memory.
NODE_MEMORY_MB = 1024
# Forests keep the node of every row between passes instead of walking all trees anew; the lineage is one step a level.
NODES_KEPT = {"cacheNodeIds": True, "checkpointInterval": -1}
# A task of a training pass holds about as many rows, whatever the number of cores.
ROWS_PER_TASK = 250_000


def classifiers(
    iterations: int = 50, trees: int = 80, depth: int = 10, rounds: int = 30, round_depth: int = 5, seed: int = 42
) -> dict[str, Estimator]:
    """The compared classifiers; weighted by class."""
    common = {"featuresCol": "features", "labelCol": BREAKDOWN_RISK.label, "weightCol": "classWeight"}
    return {
        "LogisticRegression": LogisticRegression(maxIter=iterations, **common),
        "RandomForest": RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=NODE_MEMORY_MB, **NODES_KEPT, **common
        ),
        "GBTClassifier": GBTClassifier(
            maxIter=rounds, maxDepth=round_depth, seed=seed, maxMemoryInMB=NODE_MEMORY_MB, **common
        ),
    }


def regressors(
    iterations: int = 50, trees: int = 80, depth: int = 10, rounds: int = 40, round_depth: int = 5, seed: int = 42
) -> dict[str, Estimator]:
    """The compared regressors."""
    common = {"featuresCol": "features", "labelCol": DELAY_MINUTES.label}
    return {
        "Linear Regression": LinearRegression(maxIter=iterations, regParam=0.1, elasticNetParam=0.1, **common),
        "Decision Tree": DecisionTreeRegressor(maxDepth=depth, seed=seed, maxMemoryInMB=NODE_MEMORY_MB, **common),
        "Random Forest": RandomForestRegressor(
            numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=NODE_MEMORY_MB, **NODES_KEPT, **common
        ),
        "Gradient Boosting": GBTRegressor(
            maxIter=rounds, maxDepth=round_depth, seed=seed, maxMemoryInMB=NODE_MEMORY_MB, **common
        ),
    }


def with_probability(predictions: DataFrame, name: str = "p1") -> DataFrame:
    """Probability of class 1 as a plain number."""
    return predictions.withColumn(name, vector_to_array("probability")[1])


def classification_metrics(predictions: DataFrame, label: str = BREAKDOWN_RISK.label) -> dict[str, float]:
    """All classification metrics of a prediction frame: the model is applied once for both aggregations."""
    with cached(with_probability(predictions).select(label, "prediction", "p1")) as (scored,):
        row = metrics.classification_scores(scored, label, "prediction").first().asDict()
        return {**row, **metrics.area_under_curves(scored, label, "p1").first().asDict()}


def regression_metrics(predictions: DataFrame, label: str = DELAY_MINUTES.label) -> dict[str, float]:
    """All regression metrics of a prediction frame, from one aggregation."""
    return metrics.regression_scores(predictions, label, "prediction").first().asDict()


def without_summary(model: Model, rows: DataFrame) -> Model:
    """The same model without its training summary, by way of the checkpoint folder.

    The summary holds the session and goes with the model into every task, which fails as soon as the session has
    something that cannot be sent, such as the registry of observations.
    """
    if not getattr(model, "hasSummary", False):
        return model
    folder = f"{ensure_checkpoint_dir(rows.sparkSession)}/model-{uuid.uuid4()}"
    model.save(folder)
    return type(model).load(folder)


def balanced(df: DataFrame, features: FeatureSet, most: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt over as many partitions as their number asks for; left as they are where none holds more than ``most``.

    The order inside a partition follows from the rows, and similar rows, which reach the same nodes of a tree, are
    neighbours.
    """
    sizes = partition_report(df).agg(F.max("rows").alias("largest"), F.sum("rows").alias("n")).first()
    if (sizes.largest or 0) <= most:
        return df
    order = dict.fromkeys([*features.categorical, *features.numeric, *df.columns])
    return df.repartition(-(-sizes.n // most), *df.columns).sortWithinPartitions(*order)


@dataclass
class Comparison:
    """Fitted models of one task, their predictions on the test rows and their metrics."""

    features: PipelineModel
    models: dict[str, Model] = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)
    results: list[dict[str, object]] = field(default_factory=list)
    slots: list[str] = field(default_factory=list)

    def best(self, quality: str, larger_is_better: bool = True) -> str:
        pick = max if larger_is_better else min
        return str(pick(self.results, key=lambda result: result[quality])["model"])

    def whole_model(self, name: str) -> PipelineModel:
        """Feature stages and estimator in one, so that a stored model scores prepared rows itself."""
        return PipelineModel(stages=[*self.features.stages, self.models[name]])


def compare(
    train: DataFrame,
    test: DataFrame,
    features: PipelineModel,
    estimators: Mapping[str, Estimator],
    evaluate: Callable[[DataFrame], dict[str, float]],
) -> Comparison:
    """Fit every estimator on transformed ``train`` and score it on transformed ``test``.

    One model after the other, each a series of Spark jobs over the same held training rows.
    """
    outcome = Comparison(features, slots=slot_names(features))
    for name, estimator in estimators.items():
        start = time.perf_counter()
        model = estimator.fit(train)
        seconds = time.perf_counter() - start
        model = without_summary(model, train)
        predictions = model.transform(test)
        outcome.models[name] = model
        outcome.predictions[name] = predictions
        outcome.results.append({"model": name, **evaluate(predictions), "train_seconds": round(seconds, 2)})
    return outcome


def tune_logistic(
    train: DataFrame,
    regularisation: tuple[float, ...] = REGULARISATION,
    elastic_mix: tuple[float, ...] = ELASTIC_MIX,
    folds: int = 3,
    iterations: int = 50,
    keys: tuple[str, ...] = ("busbreakdown_id",),
) -> tuple[PipelineModel, dict[str, object]]:
    """Cross-validated grid search of the logistic regression by ROC area, over prepared (not yet encoded) rows.

    Folds follow from the row key, so that they are the same on every run and cluster. Encoders and scaler are fitted
    anew for every fold, on its training side only; all settings then share the encoded rows. Settings without a penalty
    are one problem, whatever their mix, and are fitted once.
    """
    model = LogisticRegression(
        featuresCol="features", labelCol=BREAKDOWN_RISK.label, weightCol="classWeight", maxIter=iterations
    )
    judge = BinaryClassificationEvaluator(labelCol=BREAKDOWN_RISK.label, metricName="areaUnderROC")
    grid = [{model.regParam: r, model.elasticNetParam: e} for r in regularisation for e in elastic_mix]
    problems = [(r, e if r else 0.0) for r in regularisation for e in elastic_mix]
    areas: list[list[float]] = [[] for _ in grid]
    used = [*BREAKDOWN_RISK.categorical, *BREAKDOWN_RISK.numeric, BREAKDOWN_RISK.label, "classWeight"]
    with cached(with_folds(train, folds, keys).select(*used, "fold")) as (rows,):
        for fold in range(folds):
            inside, outside = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
            encoders = feature_pipeline(BREAKDOWN_RISK).fit(inside)
            columns = ["features", BREAKDOWN_RISK.label, "classWeight"]
            with cached(encoders.transform(inside).select(*columns), encoders.transform(outside).select(*columns)) as (tr, te):

                def area(problem: tuple[float, float], tr: DataFrame = tr, te: DataFrame = te) -> float:
                    setting = dict(zip((model.regParam, model.elasticNetParam), problem))
                    return judge.evaluate(without_summary(model.fit(tr, setting), tr).transform(te))

                distinct = list(dict.fromkeys(problems))
                with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
                    # Each with a copy of the session's properties of its own, as its jobs write there.
                    runs = [pool.submit(inheritable_thread_target(train.sparkSession)(area), problem) for problem in distinct]
                judged = {problem: run.result() for problem, run in zip(distinct, runs)}
                for problem, found in zip(problems, areas):
                    found.append(judged[problem])
        settings = [
            {"regParam": s[model.regParam], "elasticNetParam": s[model.elasticNetParam], "roc_auc": sum(found) / folds}
            for s, found in zip(grid, areas)
        ]
        best = max(range(len(grid)), key=lambda k: settings[k]["roc_auc"])
        encoders = feature_pipeline(BREAKDOWN_RISK).fit(rows)
        fitted = PipelineModel(stages=[*encoders.stages, without_summary(model.fit(encoders.transform(rows), grid[best]), rows)])
    return fitted, {
        "best_regParam": settings[best]["regParam"],
        "best_elasticNetParam": settings[best]["elasticNetParam"],
        "best_cv_roc_auc": settings[best]["roc_auc"],
        "settings": settings,
    }


def compare_classifiers(prepared: DataFrame, estimators: Mapping[str, Estimator] | None = None) -> Comparison:
    """Split, fit the features on the training side, and compare the classifiers."""
    return _compare_task(prepared, BREAKDOWN_RISK, estimators or classifiers(), classification_metrics, ["classWeight"])


def compare_regressors(prepared: DataFrame, estimators: Mapping[str, Estimator] | None = None) -> Comparison:
    """Split, fit the features on the training side, and compare the regressors."""
    return _compare_task(prepared, DELAY_MINUTES, estimators or regressors(), regression_metrics, [])


def _compare_task(prepared, features, estimators, evaluate, extra) -> Comparison:
    ensure_checkpoint_dir(prepared.sparkSession)  # boosting cuts its lineage there
    used = ["busbreakdown_id", *features.categorical, *features.numeric, features.label, *extra]
    columns = ["busbreakdown_id", "features", features.label, *extra]
    with cached(prepared.select(*dict.fromkeys(used))) as (rows,):
        train, test = hash_split(rows)
        fitted = feature_pipeline(features).fit(train)
        dealt = (fitted.transform(balanced(side, features)).select(*columns) for side in (train, test))
        with cached(*dealt) as (tr, te):
            return compare(tr, te, fitted, estimators, evaluate)


def importances(outcome: Comparison, name: str, top: int | None = 12) -> DataFrame | None:
    """Features by importance for a tree model (None for others)."""
    model = outcome.models[name]
    if not hasattr(model, "featureImportances"):
        return None
    values = model.featureImportances.toArray()
    spark = outcome.predictions[name].sparkSession
    # One row per slot of the feature vector.
    rows = [(slot, float(value)) for slot, value in zip(outcome.slots, values)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)


def results_frame(outcome: Comparison) -> DataFrame:
    """Metrics as rows, one per model; not the seconds, which differ from run to run."""
    spark = next(iter(outcome.predictions.values())).sparkSession
    kept = [{k: (v if k == "model" else float(v)) for k, v in r.items() if k != "train_seconds"} for r in outcome.results]
    return spark.createDataFrame(kept)
