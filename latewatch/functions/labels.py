"""Labels and derived scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two incident types and the on-time tolerance in minutes.
BREAKDOWN, RUNNING_LATE = "Breakdown", "Running Late"
ON_TIME_MINUTES = 15


def type_flag(incident_type: Column, positive: str = BREAKDOWN) -> Column:
    """1 where the type is the positive one, 0 for others, NULL for NULL."""
    return (incident_type == positive).cast("int")


def on_time_flag(delay: Column, tolerance: float = ON_TIME_MINUTES) -> Column:
    """1 within the tolerance, else 0; an unknown delay is not on time."""
    return F.coalesce((delay <= tolerance).cast("int"), F.lit(0))


def percent(rate: Column, digits: int = 1) -> Column:
    """Rate as a percentage, rounded half to even."""
    return F.bround(rate * 100, digits)


def capped_risk(rate: Column, factor: float = 3.0) -> Column:
    """Risk gauge: the rate times ``factor``, at most 1."""
    return F.least(F.lit(1.0), rate * F.lit(factor))


def residual_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """Residual and absolute error of a prediction."""
    return {"residual": actual - predicted, "abs_error": F.abs(actual - predicted)}
