"""Whole jobs: ingest, profile, relational load, and the two model comparisons.

Each reads stored tables, writes stored tables and returns only small figures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.ml import features as ml_features
from latewatch.ml import models as ml_models
from latewatch.operators import metrics, profile, quality, ranking, split, star
from latewatch.operators.features import derive_features
from latewatch.plans import sql
from latewatch.schema import DIMENSION_IDS, DIMENSION_TABLES, FACT_INCIDENT, TABLES
from latewatch.session import durable, staged
from latewatch.sources import writers
from latewatch.sources.readers import BROKEN, CAUSE, CAUSES, cause_of, read_table
from latewatch.sources.versions import Store, Version, load_new


def ingest(
    raw: DataFrame, out: str, partition_by: Sequence[str] = (), sample_rows: int = 2000, earlier: str | None = None
) -> dict[str, int]:
    """Raw records to analysis table and dimensions under ``out``.

    The raw records are read once, into a stored table of typed features; that job also counts what is kept, dropped and why.
    Dimension keys and ids come from the columns of that table. Records read by ``read_checked_records`` are checked: broken
    lines go to ``quarantine.parquet``, by cause, and are counted by cause. With ``earlier``, the folder of an earlier
    ingest, the members of its dimensions keep their ids. Returns the row counts.
    """
    spark = raw.sparkSession
    checked = BROKEN in raw.columns
    features = derive_features(raw.drop(BROKEN))
    causes: dict[str, Column] = {}
    if checked:
        cause = cause_of(F.col(BROKEN), len(raw.columns) - 1)
        raw = raw.withColumn(CAUSE, cause)
        features = derive_features(raw, BROKEN, CAUSE)
        causes = {f"broken: {name}": F.count_if(F.col(CAUSE) == name) for name in CAUSES}
    features, seen = quality.observed(features, more=causes)
    features = staged(features)
    accounts = dict(seen.get)
    if checked:
        features.filter(F.col(CAUSE).isNotNull()).select(F.col(BROKEN).alias("line"), CAUSE).write.mode("overwrite").partitionBy(
            CAUSE
        ).parquet(f"{out}/quarantine.parquet")
        features = features.filter(F.col(CAUSE).isNull()).drop(BROKEN, CAUSE)
    clean = quality.quality_filter(features)
    stored = {key: read_table(spark, f"{earlier}/dim_{key}.parquet") for key in DIMENSION_IDS} if earlier else None
    calendar = read_table(spark, f"{earlier}/dim_calendar.parquet") if earlier else None
    dimensions = star.build_dimensions(clean, stored=stored)
    writers.write_table(star.feature_table(clean, dimensions), f"{out}/incidents.parquet", partition_by)
    written = read_table(spark, f"{out}/incidents.parquet")
    writers.write_tables(
        {
            **{f"dim_{name}": table for name, table in dimensions.items()},
            "dim_calendar": durable(star.calendar_dimension(written, stored=calendar)),
            "dim_date": star.date_dimension(written),
        },
        out,
    )
    if sample_rows:
        writers.write_sample(written, f"{out}/sample.csv", sample_rows)
    return accounts


def profile_document(df: DataFrame) -> dict[str, object]:
    """Nulls, cardinalities, moments, quartiles, class balance, rates and outlier fences as one document.

    Three scans: one row of plain aggregates, the value counts of the numeric columns (quartiles and
    fences follow from them) and the level counts of the categorical ones.
    """
    nulls, moments = profile.null_measures(df.columns), profile.moment_measures(profile.NUMERICS)
    rates = [F.avg("is_breakdown").alias("breakdown_rate"), F.avg("on_time").alias("on_time_rate")]
    row = df.agg(F.count("*").alias("n_rows"), *rates, *nulls, *moments).first()
    ranked = ranking.ranked_values(df, profile.NUMERICS)
    quartiles = {r.column_name: r for r in ranking.quantiles_of(ranked, [0.25, 0.5, 0.75]).collect()}
    fenced = profile.fences_of(ranked.filter(F.col("column_name").isin("delay_minutes", "students_on_bus")))
    levels = durable(profile.level_counts(df))
    cardinality = levels.groupBy("column_name").agg(F.count("*").alias("n"))
    balance = levels.filter("column_name = 'incident_type'")
    return {
        "n_rows": row.n_rows,
        "null_counts": {c: row[f"{c}__n_nulls"] for c in df.columns},
        "cardinality": {r.column_name: r.n for r in cardinality.collect()},
        "stats": {
            c: {
                **{name: row[f"{c}__{name}"] for name in profile.STATISTICS},
                "q25": quartiles[c].q_0,
                "median": quartiles[c].q_1,
                "q75": quartiles[c].q_2,
            }
            for c in profile.NUMERICS
            if c in quartiles
        },
        "class_balance": {r.value: r.n for r in balance.collect()},
        "breakdown_rate": row.breakdown_rate,
        "on_time_rate": row.on_time_rate,
        "outliers": {r.column_name: {k: v for k, v in r.asDict().items() if k != "column_name"} for r in fenced.collect()},
    }


def relational_tables(incidents: DataFrame, dimensions: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five relational tables with their constraints applied.

    Of rows with equal primary keys the first (in the order of the other columns) is kept; rows
    without a required value are left out.
    """
    frames = {
        **{f"dim_{name}": table for name, table in dimensions.items()},
        "dim_date": star.date_dimension(incidents),
        "fact_incident": star.fact_table(incidents),
    }
    loaded = {}
    for table in TABLES:
        rows = frames[table.name].select(*table.columns)
        kept, _ = quality.split_required(rows, [*table.primary_key, *table.required])
        others = [c for c in table.columns if c not in table.primary_key]
        loaded[table.name] = quality.first_per_key(kept, table.primary_key, others)
    return loaded


def load_relational(incidents: DataFrame, dimensions: Mapping[str, DataFrame], out: str) -> dict[str, int]:
    """Write the relational tables as Parquet under ``out`` and check the foreign keys of the stored rows.

    Raises when a fact row has no parent; returns the rows per table.
    """
    spark = incidents.sparkSession
    writers.write_tables(relational_tables(incidents, dimensions), out)
    stored = {table.name: read_table(spark, f"{out}/{table.name}.parquet") for table in TABLES}
    parents = {column: (stored[name], target) for column, (name, target) in FACT_INCIDENT.references.items()}
    broken = {
        row.foreign_key: row.n_orphans
        for row in quality.orphan_counts(stored["fact_incident"], parents).collect()
        if row.n_orphans
    }
    if broken:
        raise ValueError(f"fact rows without parent: {broken}")
    return {name: table.count() for name, table in stored.items()}


def add_incidents(clean: DataFrame, folder: str) -> dict[str, int]:
    """Add usable records to the versioned relational tables under ``folder``, in one commit; returns the rows added.

    A record whose id is stored is left out, whatever its other values: the first one wins. Members of dimensions keep their
    ids, new members get the next ones. Raises, and leaves the stored version as it was, when a fact row has no parent.
    """
    store = Store(clean.sparkSession, folder)

    def frames(version: Version) -> dict[str, DataFrame]:
        stored = {t.name.removeprefix("dim_"): store.table(t, version) for t in DIMENSION_TABLES if t.name != "dim_date"}
        dimensions = star.build_dimensions(clean, stored=stored)
        rows = star.feature_table(clean, dimensions)
        named = {f"dim_{name}": table for name, table in dimensions.items()}
        return {**named, "dim_date": star.date_dimension(rows), "fact_incident": star.fact_table(rows)}

    return load_new(store, TABLES, frames, _no_orphans)


def _no_orphans(new: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> None:
    parents = {
        column: (stored[name].unionByName(new[name]), target) for column, (name, target) in FACT_INCIDENT.references.items()
    }
    counts = quality.orphan_counts(new[FACT_INCIDENT.name], parents).collect()  # one row per foreign key
    broken = {row.foreign_key: row.n_orphans for row in counts if row.n_orphans}
    if broken:
        raise ValueError(f"fact rows without parent: {broken}")


def star_queries(
    spark: SparkSession, folder: str, min_incidents: int = 5000, year: int = 2019, operator: str | None = None
) -> dict[str, DataFrame]:
    """The documented star queries over stored relational tables."""
    fact = read_table(spark, f"{folder}/fact_incident.parquet")
    dims = {t.name: read_table(spark, f"{folder}/{t.name}.parquet") for t in DIMENSION_TABLES}
    views = sql.star_frames(fact, **dims)
    answers = {
        "operator_league": sql.run_query(
            spark, sql.STAR_LEAGUE, {"min_incidents": min_incidents},
            fact_incident=views["fact_incident"], dim_operator=views["dim_operator"],
        ),
        "area_breakdowns": sql.run_query(
            spark, sql.AREA_BREAKDOWNS, {"year": year},
            fact_incident=views["fact_incident"], dim_date=views["dim_date"], dim_boro=views["dim_boro"],
        ),
        "hourly_profile": sql.run_query(spark, sql.HOURLY_PROFILE, fact_incident=views["fact_incident"]),
    }
    if operator is not None:
        answers["operator_reasons"] = sql.run_query(
            spark, sql.OPERATOR_REASONS, {"operator": operator},
            fact_incident=views["fact_incident"], dim_operator=views["dim_operator"], dim_reason=views["dim_reason"],
        )
    return answers


def classification(incidents: DataFrame, out: str, tune: bool = True, estimators=None) -> dict[str, object]:
    """Compare the breakdown classifiers, tune the logistic one, store the best model and all metrics."""
    prepared = ml_features.prepare_risk(incidents)
    outcome = ml_models.compare_classifiers(prepared, estimators)
    best = outcome.best("f1_breakdown")
    for result in outcome.results:
        result["f1_per_second"] = round(result["f1_breakdown"] / max(result["train_seconds"], 0.01), 4)
    label = ml_features.BREAKDOWN_RISK.label
    matrix = metrics.confusion_matrix(outcome.predictions[best], label, "prediction")
    document: dict[str, object] = {
        "task": "classification_is_breakdown",
        "label_balance": {str(r[label]): r["count"] for r in prepared.groupBy(label).count().collect()},
        "results": outcome.results,
        "best_model": best,
        "confusion_matrix": [r.asDict() for r in matrix.collect()],
        "roc": {name: roc_points(rows, label) for name, rows in outcome.predictions.items()},
    }
    if tune:
        _, document["cross_validation"] = ml_models.tune_logistic(split.hash_split(prepared)[0])
    writers.write_model(outcome.whole_model(best), f"{out}/model_{best}")
    writers.write_document(incidents.sparkSession, document, f"{out}/classification_metrics.json")
    return document


def roc_points(predictions: DataFrame, label: str, steps: int = 100) -> list[dict[str, float]]:
    """The ROC curve of a prediction frame for drawing: of each hundredth of the false positive rate its last point."""
    curve = metrics.roc_curve(ml_models.with_probability(predictions), label, "p1")
    step = F.floor(F.col("fpr") * steps)
    points = curve.groupBy(step.alias("step")).agg(F.max(F.struct("fpr", "tpr")).alias("p")).orderBy("step").select("p.*")
    return [r.asDict() for r in points.collect()]  # at most steps + 1 rows


def regression(incidents: DataFrame, out: str, sample: float = 0.05, estimators=None) -> dict[str, object]:
    """Compare the delay regressors, store the best model, a prediction sample and all metrics."""
    outcome = ml_models.compare_regressors(ml_features.prepare_delay(incidents), estimators)
    best = outcome.best("rmse", larger_is_better=False)
    predicted = split.hash_sample(outcome.predictions[best], sample, seed=1)
    columns = fn.residual_columns(F.col("delay_minutes"), F.col("prediction"))
    predicted.select(
        F.col("delay_minutes").alias("actual"), "prediction", *[c.alias(name) for name, c in columns.items()]
    ).write.mode("overwrite").csv(f"{out}/predictions.csv", header=True)
    ranked = ml_models.importances(outcome, best)
    document = {
        "task": "regression_delay_minutes",
        "n_rows": incidents.filter(F.col(ml_features.DELAY_MINUTES.label).isNotNull()).count(),
        "results": outcome.results,
        "best_model": best,
        "feature_importances": [r.asDict() for r in ranked.collect()] if ranked is not None else [],
    }
    writers.write_model(outcome.whole_model(best), f"{out}/model_{best.replace(' ', '_')}")
    writers.write_document(incidents.sparkSession, document, f"{out}/regression_metrics.json")
    return document
