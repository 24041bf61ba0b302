"""Time expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Record clock format, day bands (inclusive hours), seasons and weekday names.
RECORD_CLOCK = "MM/dd/yyyy hh:mm:ss a"
DAY_BANDS = {"AM_Peak": (6, 9), "Midday": (10, 13), "PM_Peak": (14, 17)}
BAND_ORDER = ("AM_Peak", "Midday", "PM_Peak", "OffPeak")
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")


def parse_timestamp(text: Column, pattern: str = RECORD_CLOCK) -> Column:
    """Timestamp of a text; anything that does not fit the pattern becomes NULL."""
    return F.try_to_timestamp(text, F.lit(pattern))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Hour, weekday (1 = Sunday), month, year and weekend flag of a timestamp."""
    weekday = F.dayofweek(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "month": F.month(ts),
        "year": F.year(ts),
        "is_weekend": weekday.isin(1, 7).cast("int"),
    }


def _named(position: Column, names: Sequence[str | None], otherwise: str) -> Column:
    """names[position] (from 0), or ``otherwise`` for a gap, another position or NULL.

    A look-up in a constant array is much less generated code than a chain of comparisons.
    """
    table = F.array(*[F.lit(name) if name else F.lit(None).cast("string") for name in names])
    return F.coalesce(F.get(table, position), F.lit(otherwise))


def time_band(
    hour: Column, bands: Mapping[str, tuple[int, int]] = DAY_BANDS, otherwise: str = "OffPeak"
) -> Column:
    """Name of the band an hour falls in; an unknown hour counts as ``otherwise``."""
    names = [next((name for name, (first, last) in bands.items() if first <= h <= last), None) for h in range(24)]
    return _named(hour, names, otherwise)


def season(
    month: Column, months: Mapping[str, Sequence[int]] = SEASON_MONTHS, otherwise: str = "Autumn"
) -> Column:
    """Season of a month; an unknown month counts as ``otherwise``."""
    names = [next((name for name, members in months.items() if m in members), None) for m in range(13)]
    return _named(month, names, otherwise)


def date_key(ts: Column) -> Column:
    """Day as yyyy-MM-dd text."""
    return F.date_format(ts, "yyyy-MM-dd")


def period_label(year: Column, month: Column) -> Column:
    """Month as yyyy-MM text."""
    return F.format_string("%d-%02d", year, month)


def weekday_label(day_of_week: Column) -> Column:
    """Sun..Sat for 1..7."""
    return F.element_at(F.array(*[F.lit(day) for day in WEEKDAYS]), day_of_week)


def is_rush(band: Column, peaks: Sequence[str] = ("AM_Peak", "PM_Peak")) -> Column:
    """Whether a band is one of the peaks."""
    return band.isin(*peaks)
