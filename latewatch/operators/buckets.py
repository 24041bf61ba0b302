"""Category bucketing and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_rare(
    df: DataFrame, column: str = "operator", top: int = 25, name: str | None = None, other: str = "OTHER"
) -> DataFrame:
    """Keep the ``top`` most frequent values of a column, as text, and call all others (and NULL) ``other``.

    The kept values are at most ``top`` rows and are joined by broadcast.
    """
    name = name or f"{column}_bucketed"
    kept = (
        df.groupBy(column)
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), F.asc_nulls_first(column))
        .limit(top)
        .select(column, F.col(column).cast("string").alias(name))
    )
    return df.join(F.broadcast(kept), column, "left").select(
        *df.columns, F.coalesce(F.col(name), F.lit(other)).alias(name)
    )


def class_weight_row(df: DataFrame, label: str = "is_breakdown") -> DataFrame:
    """Row count, positives, and inverse-frequency weights of both classes; one row, one pass.

    A class without rows has no weight (NULL).
    """
    totals = df.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"))
    negatives = F.col("n") - F.col("n_pos")
    return totals.select(
        "n",
        "n_pos",
        F.try_divide(F.col("n").cast("double"), F.col("n_pos") * 2.0).alias("w_pos"),
        F.try_divide(F.col("n").cast("double"), negatives * 2.0).alias("w_neg"),
    )


def with_class_weights(df: DataFrame, label: str = "is_breakdown", name: str = "classWeight") -> DataFrame:
    """Add the weight of each row's class."""
    weights = class_weight_row(df, label).select(F.struct("w_pos", "w_neg").alias("w")).scalar()
    weighted = df.withColumn("_w", weights)
    return weighted.withColumn(
        name, F.when(F.col(label) == 1, F.col("_w.w_pos")).otherwise(F.col("_w.w_neg"))
    ).drop("_w")
