"""Column expressions: from a Column to a Column, evaluated inside the JVM."""

from latewatch.functions.calendar import (
    calendar_parts,
    date_key,
    is_rush,
    parse_timestamp,
    period_label,
    season,
    time_band,
    weekday_label,
)
from latewatch.functions.labels import capped_risk, on_time_flag, percent, residual_columns, type_flag
from latewatch.functions.text import (
    age_group,
    clean_area,
    clean_operator,
    parse_count,
    parse_delay,
    winsorize,
    yes_flag,
)

__all__ = [
    "age_group",
    "calendar_parts",
    "capped_risk",
    "clean_area",
    "clean_operator",
    "date_key",
    "is_rush",
    "on_time_flag",
    "parse_count",
    "parse_delay",
    "parse_timestamp",
    "percent",
    "period_label",
    "residual_columns",
    "season",
    "time_band",
    "type_flag",
    "weekday_label",
    "winsorize",
    "yes_flag",
]
