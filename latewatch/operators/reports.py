"""Grouped reliability reports.

All of them are one partial and one final aggregation on the report key; a key that holds a large
part of all rows arrives at its final task as one row per map task. ``top`` reports end in a
top-k that sends k rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.functions.calendar import BAND_ORDER
from latewatch.functions.labels import BREAKDOWN, RUNNING_LATE

Measures = Mapping[str, Column]


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    measures: Measures,
    having: Column | None = None,
    order_by: Sequence[Column] = (),
    top: int | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Aggregate by key, keep groups that satisfy ``having``, order, and keep the first ``top``.

    Keys are appended to the order, so that ties always fall the same way.
    """
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    out = df.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])
    if having is not None:
        out = out.filter(having)
    if order_by or top is not None:
        out = out.orderBy(*order_by, *[F.asc_nulls_first(key) for key in keys])
    return out.limit(top) if top is not None else out


def count_by(
    df: DataFrame, *keys: str, name: str = "incidents", by_size: bool = True, top: int | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Rows per key, largest group first (or in key order)."""
    order = [F.desc(name)] if by_size else [F.asc_nulls_first(key) for key in keys]
    return grouped(df, keys, {name: F.count("*")}, order_by=order, top=top, drop_null_keys=drop_null_keys)


def by_reason(df: DataFrame, top: int = 12) -> DataFrame:
    return count_by(df, "reason", top=top)


def by_boro(df: DataFrame, top: int = 10) -> DataFrame:
    return count_by(df, "boro", top=top)


def by_hour(df: DataFrame) -> DataFrame:
    return count_by(df, "hour", by_size=False, drop_null_keys=True)


def type_by_band(df: DataFrame) -> DataFrame:
    return count_by(df, "time_band", "incident_type", name="cnt", by_size=False)


def top_operators(df: DataFrame, top: int = 10) -> DataFrame:
    return count_by(df, "operator", name="n", top=top)


def monthly_trend(df: DataFrame) -> DataFrame:
    """Incidents per month in time order, with a yyyy-MM label."""
    months = count_by(df.filter(F.col("year").isNotNull()), "year", "month", by_size=False)
    return months.select("year", "month", fn.period_label(F.col("year"), F.col("month")).alias("period"), "incidents")


def operators_by_breakdown_rate(df: DataFrame, min_n: int = 500, top: int = 15) -> DataFrame:
    return grouped(
        df,
        ["operator"],
        {"incidents": F.count("*"), "breakdown_rate": F.avg("is_breakdown")},
        having=F.col("incidents") >= min_n,
        order_by=[F.desc("breakdown_rate")],
        top=top,
    )


def operator_volume(df: DataFrame) -> DataFrame:
    return grouped(
        df,
        ["operator"],
        {"incidents": F.count("*"), "breakdown_rate": F.avg("is_breakdown"), "avg_delay": F.avg("delay_minutes")},
        order_by=[F.desc("incidents")],
    )


def average_delay_by(df: DataFrame, key: str) -> DataFrame:
    """Mean delay per non-NULL key, in key order."""
    return grouped(
        df, [key], {"avg_delay": F.avg("delay_minutes")}, order_by=[F.asc(key)], drop_null_keys=True
    )


def delay_by_weekday(df: DataFrame) -> DataFrame:
    days = average_delay_by(df, "day_of_week")
    return days.select("day_of_week", fn.weekday_label(F.col("day_of_week")).alias("dow"), "avg_delay")


def delay_by_rush(df: DataFrame) -> DataFrame:
    """Mean delay inside and outside the rush hours."""
    marked = df.select(fn.is_rush(F.col("time_band")).alias("rush"), "delay_minutes")
    label = F.when(F.col("rush"), "Rush Hour").otherwise("Non-Rush Hour").alias("label")
    return grouped(marked, ["rush"], {"avg_delay": F.avg("delay_minutes")}, order_by=[F.asc("rush")]).select(
        "rush", label, "avg_delay"
    )


def delay_by_run_type(df: DataFrame, above: int = 1000, top: int = 8) -> DataFrame:
    return grouped(
        df,
        ["run_type"],
        {"avg_delay": F.avg("delay_minutes"), "n": F.count("*")},
        having=F.col("n") > above,
        order_by=[F.desc("avg_delay")],
        top=top,
    )


def delay_by_band(df: DataFrame, bands: Sequence[str] = BAND_ORDER) -> DataFrame:
    """Mean delay per band in a fixed order; a band without rows is there with NULL."""
    positions = F.posexplode(F.array(*[F.lit(band) for band in bands])).alias("position", "time_band")
    wanted = df.sparkSession.range(1).select(positions)
    found = df.groupBy("time_band").agg(F.avg("delay_minutes").alias("avg_delay"))
    return wanted.join(found, "time_band", "left").select("position", "time_band", "avg_delay").orderBy("position")


def breakdown_rate_by_boro(df: DataFrame, above: int = 2000, top: int = 10) -> DataFrame:
    return grouped(
        df,
        ["boro"],
        {"rate": F.avg("is_breakdown"), "n": F.count("*")},
        having=F.col("n") > above,
        order_by=[F.desc("rate")],
        top=top,
        drop_null_keys=True,
    )


def types_by_year(df: DataFrame, first: int = 2015, last: int = 2026) -> DataFrame:
    """Incidents per year and type, one column per type, 0 where there are none."""
    kinds = {RUNNING_LATE: "running_late", BREAKDOWN: "breakdown"}
    table = (
        df.filter(F.col("year").between(first, last))
        .groupBy("year")
        .pivot("incident_type", list(kinds))
        .count()
        .na.fill(0)
    )
    return table.withColumnsRenamed(kinds).orderBy("year")


def type_share(df: DataFrame) -> DataFrame:
    """Breakdowns, all other incidents, and the breakdown share."""
    totals = df.agg(F.coalesce(F.sum("is_breakdown"), F.lit(0)).alias("breakdowns"), F.count("*").alias("n"))
    return totals.select(
        "breakdowns",
        (F.col("n") - F.col("breakdowns")).alias("others"),
        F.try_divide(F.col("breakdowns"), F.col("n")).alias("breakdown_share"),
    )


def class_balance(df: DataFrame) -> DataFrame:
    return count_by(df, "incident_type", name="cnt", by_size=False)


def global_rates(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("is_breakdown").alias("breakdown_rate"), F.avg("on_time").alias("on_time_rate"))
