"""Model metrics in plain DataFrame form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.operators.joins import join_dimension
from latewatch.operators.ranking import running_totals
from latewatch.session import durable


def history(train: DataFrame, keys: Sequence[str], targets: Mapping[str, str]) -> DataFrame:
    """Sum and number of each target per key combination (new name -> target)."""
    sums = [F.sum(target).alias(f"{name}_sum") for name, target in targets.items()]
    counts = [F.count(target).alias(f"{name}_n") for name, target in targets.items()]
    return train.groupBy(*keys).agg(*sums, *counts)


def score_by_history(
    train: DataFrame, test: DataFrame, keys: Sequence[str], targets: Mapping[str, str]
) -> DataFrame:
    """Add the historical mean of each target for each row's key combination.

    Unseen combinations get the overall mean. The history is computed once, kept in the checkpoint
    folder and measured there; group means and overall means both come from it.
    """
    past = durable(history(train, keys, targets))
    means = past.select(
        *keys, *[F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")).alias(name) for name in targets]
    ).dropna(subset=list(keys))
    overall = past.agg(
        F.struct(
            *[F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in targets]
        ).alias("overall")
    )
    joined = join_dimension(test, means, list(keys)).withColumn("_overall", overall.scalar())
    filled = {name: F.coalesce(F.col(name), F.col(f"_overall.{name}")) for name in targets}
    return joined.withColumns(filled).drop("_overall")


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows per label and predicted class, 0 where there are none: (label, predicted_0, predicted_1).

    Every class is a row, also one that no row has; so is any other label of the data.
    """
    kind = df.schema[label].dataType
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("label"))
    table = (
        df.groupBy(F.col(label).alias("label"))
        .pivot(prediction, [float(c) for c in classes])
        .count()
        .withColumnsRenamed({str(float(c)): f"predicted_{c}" for c in classes})
    )
    return listed.join(table, "label", "full").na.fill(0, [f"predicted_{c}" for c in classes]).orderBy("label")


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def _ranked_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    return running_totals(_score_groups(df, label, score), "threshold", ["pos", "neg"], descending=True)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down, and the origin.

    Equal scores form one point, so that the curve does not depend on row order.
    """
    ranked = _ranked_scores(df, label, score)
    points = ranked.select(
        "threshold",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
        F.try_divide(F.col("cum_neg"), F.col("all_neg")).alias("fpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
        F.lit(0.0).alias("tpr"),
        F.lit(0.0).alias("fpr"),
    )
    return origin.unionByName(points)


def area_under_curves(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve (trapezoids over distinct scores)."""
    ranked = _ranked_scores(df, label, score)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp_before, fp_before = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    # The curve starts at recall 0 with the precision of its first point.
    precision_before = F.coalesce(F.try_divide(tp_before, tp_before + fp_before), precision)
    return ranked.agg(
        F.try_divide(
            F.sum(F.col("neg") * (tp + tp_before) / 2.0), F.first("all_pos") * F.first("all_neg").cast("double")
        ).alias("roc_auc"),
        F.try_divide(
            F.sum(F.col("pos") * (precision + precision_before) / 2.0), F.first("all_pos").cast("double")
        ).alias("pr_auc"),
    )


def _counts(label: str, prediction: str) -> dict[str, Column]:
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    return {
        "tp": F.count_if(truth & guess),
        "fp": F.count_if(~truth & guess),
        "fn": F.count_if(truth & ~guess),
        "tn": F.count_if(~truth & ~guess),
    }


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, and weighted F1; one row, one pass."""
    row = df.agg(*[count.alias(name) for name, count in _counts(label, prediction).items()])
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1_pos, f1_neg = _ratio(tp * 2, tp * 2 + fp + fn), _ratio(tn * 2, tn * 2 + fp + fn)
    return row.select(
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision_breakdown"),
        _ratio(tp, tp + fn).alias("recall_breakdown"),
        f1_pos.alias("f1_breakdown"),
        _ratio(f1_pos * (tp + fn) + f1_neg * (tn + fp), n).alias("f1_weighted"),
    )


def regression_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared error, mean absolute error and R squared; one row, one pass."""
    actual = F.col(label).cast("double")
    error = actual - F.col(prediction)
    return (
        df.filter(actual.isNotNull() & F.col(prediction).isNotNull())
        .agg(
            F.avg(error * error).alias("mse"),
            F.avg(F.abs(error)).alias("mae"),
            F.var_pop(actual).alias("variance"),
        )
        .select(
            F.sqrt("mse").alias("rmse"),
            "mae",
            (1 - F.try_divide(F.col("mse"), F.col("variance"))).alias("r2"),
        )
    )


def rank_models(metrics: DataFrame, quality: str, cost: str, larger_is_better: bool = True) -> DataFrame:
    """Models from best to worst with quality per unit of cost and cost relative to the cheapest.

    ``metrics`` holds one row per model.
    """
    facts = metrics.agg(F.min(cost)).scalar()
    best = F.desc(quality) if larger_is_better else F.asc(quality)
    return metrics.select(
        "*",
        F.try_divide(F.col(quality), F.col(cost)).alias("quality_per_cost"),
        F.try_divide(F.col(cost), facts).alias("relative_cost"),
    ).orderBy(best, "model")


def best_model(metrics: DataFrame, quality: str, larger_is_better: bool = True) -> DataFrame:
    """Name and quality of the best model; one row."""
    pick = F.max_by if larger_is_better else F.min_by
    edge = F.max if larger_is_better else F.min
    return metrics.agg(pick("model", quality).alias("model"), edge(quality).alias(quality))
