"""Shapes of distributions: histograms, density, box and quantile-quantile figures."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.operators.ranking import quantile_rows, quantiles_of, ranked_values
from latewatch.session import staged


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin; the upper end belongs to the last bin."""
    inside = F.when(value >= high, F.lit(bins)).otherwise(F.width_bucket(value, low, high, F.lit(bins)).cast("int"))
    return F.when(low < high, inside).when(value.isNotNull(), F.lit(1))


def histogram(
    df: DataFrame, column: str, bins: int = 40, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows per equal-width bin over the given or the found range: (bin, low_edge, high_edge, n).

    Every bin is there, empty ones with 0 (a range without width is one bin, no value at all no
    bin). Values outside a given range, on either side, are not counted. To find a range the values are stored
    first (one number a row); the counting shuffles one row per bin and task.
    """
    number = F.col(column).cast("double")
    if low is None or high is None:
        # Read twice, so stored: what a value is parsed from is evaluated once, in a projection of its own.
        stored = staged(df.select(number.alias("value")))
        values = stored.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        found = values.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()  # one row
        low, high = found.low, found.high
    else:
        values = df.select(number.alias("value"))
    start, end = F.lit(low).cast("double"), F.lit(high).cast("double")
    counted = (
        values.filter(F.col("value").between(start, end))
        .groupBy(bin_number(F.col("value"), start, end, bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    last = 0 if low is None else bins if low < high else 1 if low == high else 0
    listed = df.sparkSession.range(1, last + 1).select(F.col("id").cast("int").alias("bin"))
    step = (end - start) / bins
    # At most ``bins`` rows on either side.
    return (
        listed.join(F.broadcast(counted), "bin", "left")
        .select(
            "bin",
            (start + (F.col("bin") - 1) * step).alias("low_edge"),
            (start + F.col("bin") * step).alias("high_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def centre_marks(df: DataFrame, column: str) -> DataFrame:
    """Number of values, mean and (interpolated) median: (column_name, n, mean, median).

    Both come from the value counts, in one scan.
    """
    counts = ranked_values(df, [column])
    median = quantiles_of(counts, [0.5], interpolate=True)
    mean = counts.groupBy("column_name").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    return median.join(mean, "column_name").select("column_name", "n", "mean", F.col("q_0").alias("median"))


# A kernel is 0, to a double's precision, this many bandwidths away.
REACH = 9.0


def density(
    df: DataFrame, column: str, points: int = 200, bandwidth: float | None = None, bins_per_width: int | None = None
) -> DataFrame:
    """Gaussian kernel density at ``points`` equally spaced places over the data's range.

    Bandwidth by Scott's rule unless given; without a spread (a constant column, a single row) there is no density: it is
    NULL at every place. The kernel sum runs over distinct values weighted by their counts, and a value meets only the
    places within reach. With ``bins_per_width`` values are first shared out, linearly, between the ends of
    bins of that part of a bandwidth, so that the sum runs over bins and does not grow with the number of distinct values.
    """
    values = staged(df.select(F.col(column).cast("double").alias("value"))).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # One row: everything the grid and the kernel width need. Deviations are from the mean, merged as they come.
    facts = values.agg(
        F.count("*").alias("n"), F.stddev("value").alias("spread"), F.min("value").alias("low"), F.max("value").alias("high")
    ).first()
    width = bandwidth or (facts.spread * facts.n**-0.2 if facts.spread else None)
    places = df.sparkSession.range(points if facts.n else 0).select(F.col("id").cast("int").alias("point"))
    if not facts.n or not width:
        x = F.lit(facts.low).cast("double")
        return places.select("point", x.alias("x"), F.lit(None).cast("double").alias("density")).orderBy("point")
    low, step = F.lit(facts.low), (facts.high - facts.low) / (points - 1)
    if bins_per_width:
        at = (F.col("value") - low) * (bins_per_width / width)
        ends = F.array(
            F.struct(F.floor(at).alias("bin"), (F.floor(at) + 1 - at).alias("weight")),
            F.struct((F.floor(at) + 1).alias("bin"), (at - F.floor(at)).alias("weight")),
        )
        shared = values.select(F.inline(ends)).groupBy("bin").agg(F.sum("weight").alias("weight"))
        weights = shared.select((low + F.col("bin") * (width / bins_per_width)).alias("value"), "weight")
    else:
        weights = values.groupBy("value").agg(F.count("*").alias("weight"))
    if step:
        first = F.greatest(F.ceil((F.col("value") - low - REACH * width) / step), F.lit(0))
        last = F.least(F.floor((F.col("value") - low + REACH * width) / step), F.lit(points - 1))
        near = F.when(first <= last, F.sequence(first, last))
    else:
        near = F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")
    z = (low + F.col("point") * step - F.col("value")) / width
    summed = (
        weights.select("value", "weight", F.explode(near).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.col("weight") * F.exp(z * z * -0.5)).alias("total"))
    )
    # One row a place on either side.
    return (
        places.join(F.broadcast(summed), "point", "left")
        .select(
            "point",
            (low + F.col("point") * step).alias("x"),
            (F.coalesce("total", F.lit(0.0)) / (facts.n * width * math.sqrt(2 * math.pi))).alias("density"),
        )
        .orderBy("point")
    )


def box_figures(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values within the fences) and number of fliers; one scan."""
    counts = ranked_values(df, [column])
    quartiles = quantiles_of(counts, [0.25, 0.5, 0.75])
    reach = (F.col("q_2") - F.col("q_0")) * factor
    inside = F.col("value").between(F.col("q_0") - reach, F.col("q_2") + reach)
    # The quartiles are one row.
    return (
        counts.join(F.broadcast(quartiles.drop("n")), "column_name")
        .groupBy("column_name", F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_fliers"),
        )
    )


def joint_histogram(
    df: DataFrame, x: str, y: str, low: float, high: float, bins: int = 20
) -> DataFrame:
    """Rows per cell of two equally binned columns: (x_bin, y_bin, n)."""
    edges = F.lit(float(low)), F.lit(float(high))

    def cell(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(value < edges[0], F.lit(0)).otherwise(bin_number(value, *edges, bins))

    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(cell(x).alias("x_bin"), cell(y).alias("y_bin")).agg(F.count("*").alias("n"))


def normal_places(points: int) -> list[tuple[float, float]]:
    """Probability and standard-normal quantile of ``points`` evenly placed probabilities."""
    levels = [(i + 0.5) / points for i in range(points)]
    return [(p, NormalDist().inv_cdf(p)) for p in levels]


def normal_quantile_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Quantile-quantile figures against the normal distribution.

    (point, theoretical, observed) plus slope and intercept of the fitted line. The data quantiles
    are exact and computed over all rows; only ``points`` rows remain for the line.
    """
    places = normal_places(points)
    found = quantile_rows(ranked_values(df, [column]), [p for p, _ in places])
    theoretical = F.element_at(F.array(*[F.lit(z) for _, z in places]), F.col("point") + 1)
    listed = found.select("point", theoretical.alias("theoretical"), F.col("value").alias("observed"))
    line = listed.agg(
        F.struct(
            F.regr_slope("observed", "theoretical").alias("slope"),
            F.regr_intercept("observed", "theoretical").alias("intercept"),
        ).alias("line")
    )
    return listed.withColumn("_l", line.scalar()).select(
        "*", F.col("_l.slope").alias("slope"), F.col("_l.intercept").alias("intercept")
    ).drop("_l").orderBy("point")


__all__: Sequence[str] = (
    "bin_number",
    "box_figures",
    "centre_marks",
    "density",
    "histogram",
    "joint_histogram",
    "normal_places",
    "normal_quantile_points",
)
