"""Stored sketches of columns: quantiles and distinct counts of many days without reading the days again.

A row holds, for one group of rows (a day, a file, a load) and one column, the numbers of rows and of NULLs and two
mergeable sketches of a fixed size: KLL for the order of numeric values, HyperLogLog for distinct ones. Rows of new
groups are added to the stored ones; figures over any choice of groups come from merging their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# KLL's k: 800 puts a quantile within 0.4 % of its rank; 2 to the 13 registers a distinct count within about 1 %.
KLL_SIZE, HLL_SIZE = 800, 13


def sketch_rows(df: DataFrame, by: Sequence[str], numerics: Sequence[str] = (), others: Sequence[str] = ()) -> DataFrame:
    """One row per group and column: ``*by, column_name, n, n_nulls, quantiles, distinct`` (sketches, binary).

    ``quantiles`` is NULL for columns that are not numeric, and where a group has no value; NaN counts as missing. One scan,
    and one row per group and column of every task is shuffled.
    """
    columns = {c: F.col(c).cast("double") for c in numerics}
    measures: list[Column] = []
    for c, value in columns.items():
        known = F.when(~F.isnan(value), value)
        measures += [
            F.struct(
                F.count("*").alias("n"),
                F.count_if(known.isNull()).alias("n_nulls"),
                F.when(F.count(known) > 0, F.kll_sketch_agg_double(known, KLL_SIZE)).alias("quantiles"),
                F.hll_sketch_agg(known.cast("string"), HLL_SIZE).alias("distinct"),
            ).alias(c)
        ]
    for c in others:
        measures += [
            F.struct(
                F.count("*").alias("n"),
                F.count_if(F.col(c).isNull()).alias("n_nulls"),
                F.lit(None).cast("binary").alias("quantiles"),
                F.hll_sketch_agg(F.col(c).cast("string"), HLL_SIZE).alias("distinct"),
            ).alias(c)
        ]
    rows = df.groupBy(*by).agg(*measures)
    names = [*numerics, *others]
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}`.{part}").alias(part) for part in ("n", "n_nulls", "quantiles", "distinct")])
            for c in names
        ]
    )
    return rows.select(*by, F.inline(lines))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows over all groups, or coarser ones: ``*by, column_name, n, n_nulls, quantiles, distinct``."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"),
        F.sum("n_nulls").alias("n_nulls"),
        F.kll_merge_agg_double("quantiles", KLL_SIZE).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def quantiles_from(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """Quantiles ``q_0, q_1, …`` of merged sketches: ``*by, column_name, n`` (values) and one column for each probability."""
    found = merged(sketches.filter(F.col("quantiles").isNotNull()), by)
    return found.select(
        *by, "column_name", (F.col("n") - F.col("n_nulls")).alias("n"),
        *[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))).alias(f"q_{i}") for i, p in enumerate(probabilities)],
    )


def distinct_from(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values, NULL counted as a value: ``*by, column_name, n_distinct``."""
    found = F.hll_sketch_estimate("distinct") + (F.col("n_nulls") > 0).cast("bigint")
    return merged(sketches, by).select(*by, "column_name", found.alias("n_distinct"))


def fences_from(sketches: DataFrame, factor: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and interquartile fences: ``*by, column_name, q1, q3, iqr, lower, upper``."""
    found = quantiles_from(sketches, (0.25, 0.75), by)
    q1, q3 = F.col("q_0"), F.col("q_1")
    reach = (q3 - q1) * factor
    return found.select(
        *by, "column_name", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), (q1 - reach).alias("lower"), (q3 + reach).alias("upper")
    )


def add_sketches(sketches: DataFrame, path: str) -> None:
    """Append sketch rows of new groups to the stored ones."""
    sketches.write.mode("append").parquet(path)
