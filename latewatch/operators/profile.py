"""Column profiling."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.operators.ranking import quantiles_of, ranked_values

# The columns the standard profile covers.
CATEGORICALS = ("operator", "boro", "reason", "run_type", "time_band", "season", "school_year", "incident_type")
NUMERICS = ("delay_minutes", "students_on_bus", "hour")
CORRELATED = (
    "delay_minutes",
    "students_on_bus",
    "hour",
    "month",
    "day_of_week",
    "is_weekend",
    "notified_schools",
    "notified_parents",
    "alerted_opt",
    "on_time",
    "is_breakdown",
)


# Rows that the shift of a correlation is taken from.
SHIFT_ROWS = 64
# Statistics of a numeric column; skewness and excess kurtosis are those of the population.
STATISTICS = {"mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max, "skew": F.skewness, "kurt": F.kurtosis}


def _one_row_per_column(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row of ``<column>__<field>`` values into one row per column."""
    lines = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{name}").alias(name) for name in fields])
        for c in columns
    ]
    return row.select(F.inline(F.array(*lines)))


def null_measures(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{c}__n_nulls") for c in columns]


def moment_measures(columns: Sequence[str]) -> list[Column]:
    return [f(F.col(c).cast("double")).alias(f"{c}__{name}") for c in columns for name, f in STATISTICS.items()]


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    names = list(columns or df.columns)
    return _one_row_per_column(df.agg(*null_measures(names)), names, ["n_nulls"])


def level_counts(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    """Rows per value of several categorical columns, NULL included, in one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def cardinality(
    df: DataFrame, columns: Sequence[str] = CATEGORICALS, approximate: bool = False, error: float = 0.02
) -> DataFrame:
    """Distinct values per column, NULL counted as a value; one pass for all columns.

    The approximate form keeps a fixed-size sketch per column and shuffles only those.
    """
    if approximate:
        row = df.agg(
            *[
                (F.approx_count_distinct(c, error) + F.max(F.col(c).isNull().cast("bigint"))).alias(f"{c}__n_distinct")
                for c in columns
            ]
        )
        return _one_row_per_column(row, columns, ["n_distinct"])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return long.distinct().groupBy("column_name").agg(F.count("*").alias("n_distinct"))


def numeric_profile(df: DataFrame, columns: Sequence[str] = NUMERICS) -> DataFrame:
    """Mean, sample deviation, extremes, population skewness and excess kurtosis; one pass."""
    return _one_row_per_column(df.agg(*moment_measures(columns)), columns, list(STATISTICS))


def outlier_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5, error: float = 0.0) -> DataFrame:
    """Quartiles, interquartile fences and the number of values outside them, per column.

    Exact form: quartiles and outliers both come from one table of value counts, so the data is
    scanned once. A positive rank error takes one sketch pass and one counting pass instead.
    """
    if error > 0:
        return _sketched_fences(df, columns, factor, error)
    return fences_of(ranked_values(df, columns), factor)


def fences_of(counts: DataFrame, factor: float = 1.5) -> DataFrame:
    """Outlier fences from ranked value counts."""
    quartiles = quantiles_of(counts, [0.25, 0.75]).select("column_name", *_fences("q_0", "q_1", factor))
    # One row per profiled column.
    return (
        counts.join(F.broadcast(quartiles), "column_name")
        .groupBy("column_name", "q1", "q3", "iqr", "lower", "upper")
        .agg(
            F.coalesce(
                F.sum(F.when((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")), F.col("n"))),
                F.lit(0),
            ).alias("n_outliers")
        )
    )


def _fences(low: str, high: str, factor: float) -> list[Column]:
    q1, q3 = F.col(low), F.col(high)
    return [
        q1.alias("q1"),
        q3.alias("q3"),
        (q3 - q1).alias("iqr"),
        (q1 - (q3 - q1) * factor).alias("lower"),
        (q3 + (q3 - q1) * factor).alias("upper"),
    ]


def _sketched_fences(df: DataFrame, columns: Sequence[str], factor: float, error: float) -> DataFrame:
    accuracy = max(1, round(1 / error))
    sketch = df.agg(
        F.struct(
            *[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.75], accuracy).alias(c) for c in columns]
        ).alias("quartiles")
    )
    located = df.select(*columns).withColumn("_q", sketch.scalar())
    counted = []
    for c in columns:
        q1, q3 = F.col(f"_q.{c}")[0], F.col(f"_q.{c}")[1]
        reach = (q3 - q1) * factor
        outside = (F.col(c) < q1 - reach) | (F.col(c) > q3 + reach)
        counted += [
            F.max(q1).alias(f"{c}__q1"),
            F.max(q3).alias(f"{c}__q3"),
            F.count_if(outside).alias(f"{c}__n_outliers"),
        ]
    rows = _one_row_per_column(located.agg(*counted), columns, ["q1", "q3", "n_outliers"])
    return rows.select("column_name", *_fences("q1", "q3", factor), "n_outliers")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED, fill: float = 0.0) -> DataFrame:
    """Pearson correlation of every pair of columns as (row_name, column_name, r).

    Missing values count as ``fill``; a constant column gives NULL. One scan adds up the products of deviations from a
    shift, a middle value of the first rows: near enough to the data that no digits are lost for values far from zero, and a
    plain sum per pair costs a fraction of a running covariance. The number of pairs depends on the column list, not the data.
    """
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(c) for c in columns])
    head = filled.limit(SHIFT_ROWS).collect()  # a bounded number of rows
    shift = {c: sorted(row[c] for row in head)[len(head) // 2] if head else 0.0 for c in columns}
    moved = filled.select(*[(F.col(c) - F.lit(shift[c])).alias(c) for c in columns])
    pairs = list(combinations_with_replacement(columns, 2))
    row = moved.agg(
        F.count("*").cast("double").alias("_n"),
        *[F.sum(c).alias(f"{c}__sum") for c in columns],
        *[F.expr(f"sum(`{a}` * `{b}`) AS `{a}__{b}`") for a, b in pairs],
    ).select(*[F.expr(f"`{a}__{b}` - `{a}__sum` * `{b}__sum` / _n AS `{a}__{b}`") for a, b in pairs])
    lines = [
        f"named_struct('a', '{a}', 'b', '{b}', 'ab', `{a}__{b}`, 'aa', `{a}__{a}`, 'bb', `{b}__{b}`)" for a, b in pairs
    ]
    sums = row.selectExpr(f"inline(array({', '.join(lines)}))")
    r = (
        F.when(F.col("a") == F.col("b"), F.when(F.col("aa") > 0, F.lit(1.0)))
        .when((F.col("aa") > 0) & (F.col("bb") > 0), F.expr("greatest(-1.0D, least(1.0D, ab / (sqrt(aa) * sqrt(bb))))"))
        .alias("r")
    )
    # Every pair of different columns stands in both triangles of the matrix.
    both = F.expr(
        "CASE WHEN a = b THEN array(struct(a, b)) ELSE array(struct(a, b), struct(b AS a, a AS b)) END"
    )
    return sums.select(F.explode(both).alias("pair"), r).select(
        F.col("pair.a").alias("row_name"), F.col("pair.b").alias("column_name"), "r"
    )
