"""Interactive views: one filtered selection and the figures over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.functions.calendar import BAND_ORDER
from latewatch.operators.reports import count_by, grouped

ALL = "(All)"


def select_incidents(
    df: DataFrame,
    years: tuple[int, int] | None = None,
    bands: Sequence[str] = BAND_ORDER,
    boro: str = ALL,
) -> DataFrame:
    """Rows in an inclusive year range, in some time bands and, unless all are wanted, in one area.

    Plain predicates on stored columns, so that they reach the scan; a table laid out by year
    skips the other years.
    """
    if years:
        df = df.filter(F.col("year").between(*years))
    df = df.filter(F.col("time_band").isin(*bands))
    return df if boro == ALL else df.filter(F.col("boro") == boro)


def filter_options(df: DataFrame, columns: Sequence[str] = ("year", "boro", "operator")) -> DataFrame:
    """Sorted distinct non-NULL values to choose from, all columns in one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "filter", "choice"
    )
    return long.filter(F.col("choice").isNotNull()).distinct().orderBy("filter", "choice")


def key_figures(df: DataFrame) -> DataFrame:
    """Incidents, breakdown per cent, mean delay and on-time per cent; one row."""
    return df.agg(
        F.count("*").alias("incidents"),
        (F.avg("is_breakdown") * 100).alias("breakdown_percent"),
        F.avg("delay_minutes").alias("avg_delay"),
        (F.avg("on_time") * 100).alias("on_time_percent"),
    )


def counts_by_boro(df: DataFrame) -> DataFrame:
    return grouped(df, ["boro"], {"incidents": F.count("*")}, order_by=[F.asc("incidents")], drop_null_keys=True)


def counts_by_reason(df: DataFrame, top: int = 10) -> DataFrame:
    return count_by(df, "reason", top=top, drop_null_keys=True)


def counts_by_hour(df: DataFrame) -> DataFrame:
    return count_by(df, "hour", by_size=False, drop_null_keys=True)


def league(df: DataFrame, min_n: int = 500, top: int = 15) -> DataFrame:
    """Operators with the highest breakdown rate; per cent and minutes to one digit, half to even."""
    rates = grouped(
        df,
        ["operator"],
        {"incidents": F.count("*"), "rate": F.avg("is_breakdown"), "delay": F.avg("delay_minutes")},
        having=F.col("incidents") >= min_n,
        order_by=[F.desc("rate")],
        top=top,
        drop_null_keys=True,
    )
    return rates.select(
        "operator",
        "incidents",
        fn.percent(F.col("rate")).alias("breakdown_rate"),
        F.bround("delay", 1).alias("avg_delay"),
    )


def risk_grid(df: DataFrame, keys: Sequence[str] = ("operator", "time_band")) -> DataFrame:
    """Historical breakdown risk, its gauge value and the number of incidents per key combination."""
    grid = grouped(df, keys, {"incidents": F.count("*"), "risk": F.avg("is_breakdown")}, drop_null_keys=True)
    return grid.select(*keys, "incidents", "risk", fn.capped_risk(F.col("risk")).alias("gauge"))


def risk_lookup(df: DataFrame, operator: str, band: str) -> DataFrame:
    """Risk of one operator in one band; no row where there are no incidents."""
    return risk_grid(df.filter((F.col("operator") == operator) & (F.col("time_band") == band)))
