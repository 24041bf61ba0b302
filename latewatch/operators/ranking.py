"""Ordered ids, running totals and exact quantiles without an unbounded one-task window.

A window without partition key moves every row to one task. Here the rows are range-partitioned by their key, as many
ways as the session shuffles, and stored with the number of their partition. Totals per partition and group are a
small table; running sums over it say what comes before each partition, and every partition is then summed by itself.
It is one form for all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from latewatch.session import durable


def ordered_parts(df: DataFrame, *order: str) -> DataFrame:
    """Stored rows with ``_part``: rows with a smaller key never have a larger part, NULLs come first."""
    return durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def running_totals(
    df: DataFrame, order: str, measures: Sequence[str], descending: bool = False, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<m>`` (running) and ``all_<m>`` (overall) sums of each measure, per ``within``.

    Rows must be distinct on ``within`` and ``order``. ``within`` stands for a few non-NULL groups
    (such as column names).
    """
    placed = ordered_parts(df, *within, order)
    totals = placed.groupBy(*within, "_part").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    by_part = F.desc("_part") if descending else F.asc("_part")
    before = W.Window.partitionBy(*within).orderBy(by_part).rowsBetween(W.Window.unboundedPreceding, -1)
    overall = W.Window.partitionBy(*within)
    offsets = totals.select(
        *within,
        "_part",
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(overall).alias(f"all_{m}") for m in measures],
    )
    # At most one row per partition, and one more per group.
    joined = placed.join(F.broadcast(offsets), [*within, "_part"])
    by_key = F.desc(order) if descending else F.asc(order)
    upto = W.Window.partitionBy(*within, "_part").orderBy(by_key).rowsBetween(W.Window.unboundedPreceding, 0)
    running = [(F.sum(m).over(upto) + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures]
    return joined.select(*df.columns, *running, *[f"all_{m}" for m in measures])


def dense_ids(keys: DataFrame, columns: Sequence[str], name: str, within: Sequence[str] = ()) -> DataFrame:
    """Number distinct keys 1..n in key order, NULLs first (per ``within`` group)."""
    # A struct compares field by field with NULLs first and is never NULL itself.
    ordered = keys.select(
        *within, *columns, F.struct(*columns).alias("_order"), F.lit(1).cast("bigint").alias("one")
    )
    ranked = running_totals(ordered, "_order", ["one"], within=within)
    return ranked.select(*within, *columns, F.col("cum_one").alias(name))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Occurrences of every value of several numeric columns in one pass. NaN counts as missing, like NULL."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    known = F.col("value").isNotNull() & ~F.isnan("value")
    return long.filter(known).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def ranked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts with their running and overall number per column: the basis of exact quantiles."""
    return running_totals(value_counts(df, columns), "value", ["n"], within=["column_name"])


def quantiles_of(ranked: DataFrame, probabilities: Sequence[float], interpolate: bool = False) -> DataFrame:
    """Exact quantiles ``q_0, q_1, …`` per column of ranked value counts.

    Without interpolation the result is an element of the data (the discrete percentile).
    """
    columns: list[Column] = [F.first("all_n").alias("n")]
    for i, p in enumerate(map(float, probabilities)):
        if interpolate:
            place = f"(all_n - 1) * {p!r}D"
            low = f"min(CASE WHEN cum_n > floor({place}) THEN value END)"
            high = f"min(CASE WHEN cum_n > ceil({place}) THEN value END)"
            columns.append(F.expr(f"{low} + ({high} - {low}) * first({place} - floor({place}))").alias(f"q_{i}"))
        else:
            columns.append(F.expr(f"min(CASE WHEN cum_n >= all_n * {p!r}D THEN value END)").alias(f"q_{i}"))
    return ranked.groupBy("column_name").agg(*columns)


def quantile_rows(ranked: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Discrete quantiles as rows (column_name, point, probability, value); for long lists.

    Each value names the probabilities that end on it, so that nothing has to be aggregated.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("point"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])
    hit = F.filter(
        "_listed",
        lambda s: (F.greatest(s["p"] * F.col("all_n"), F.lit(1.0)) > F.col("cum_n") - F.col("n"))
        & (F.greatest(s["p"] * F.col("all_n"), F.lit(1.0)) <= F.col("cum_n")),
    )
    found = ranked.withColumn("_listed", listed).select("column_name", "value", F.explode(hit).alias("s"))
    return found.select("column_name", F.col("s.point").alias("point"), F.col("s.p").alias("probability"), "value")


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    error: float = 0.0,
    interpolate: bool = False,
) -> DataFrame:
    """Quantiles ``q_0, q_1, …`` of numeric columns, one row per column.

    ``error`` 0 is exact over value counts (one row per distinct value is shuffled); a positive rank
    error uses one mergeable sketch per column and shuffles only those.
    """
    if error <= 0:
        return quantiles_of(ranked_values(df, columns), probabilities, interpolate)
    accuracy = max(1, round(1 / error))
    row = df.agg(
        *[F.count(c).alias(f"{c}_n") for c in columns],
        *[F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(c) for c in columns],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}_n").alias("n"),
            *[F.col(c)[i].alias(f"q_{i}") for i in range(len(probabilities))],
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*lines)))
