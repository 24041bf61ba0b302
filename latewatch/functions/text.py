"""Cleaning of free-text fields. All parses are lenient: what cannot be read is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the record format and the delay cap in minutes.
RANGE_PATTERN = r"(\d+)\s*-\s*(\d+)"
NUMBER_PATTERN = r"(\d+)"
COMPANY_TAIL_PATTERN = r"[.,]*\s*\(.*$|[.,]+$"
HOUR_WORDS = ("HOUR", "HR")
DELAY_CAP = 180.0


def parse_delay(text: Column) -> Column:
    """Minutes named by a free text.

    A range of two positive numbers gives its middle and is never scaled; otherwise the first
    number counts, times 60 where an hour word occurs. The substring tests spare the regular
    expressions on texts that cannot match them.
    """
    shout = F.upper(F.trim(text))

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(shout, pattern, group).try_cast("double")

    low, high = number(RANGE_PATTERN, 1), number(RANGE_PATTERN, 2)
    middle = F.when(shout.contains("-") & (low > 0) & (high > 0), (low + high) / 2)
    first, *rest = [shout.contains(word) for word in HOUR_WORDS]
    in_hours = first
    for test in rest:
        in_hours = in_hours | test
    scale = F.when(in_hours, F.lit(60.0)).otherwise(F.lit(1.0))
    return F.coalesce(middle, number(NUMBER_PATTERN, 1) * scale)


def winsorize(value: Column, cap: float = DELAY_CAP, floor: float = 0.0) -> Column:
    """Values above ``cap`` become ``cap``; values below ``floor`` become NULL."""
    return F.when(value >= floor, F.least(value, F.lit(cap)))


def clean_operator(text: Column, missing: str = "UNKNOWN") -> Column:
    """Upper-case company name without vendor code and trailing marks; blank becomes ``missing``."""
    # One pattern for the bracketed code with the marks before it, or the marks at the end.
    name = F.regexp_replace(F.upper(F.trim(text)), COMPANY_TAIL_PATTERN, "")
    return F.when(name == "", F.lit(missing)).otherwise(name)


def clean_area(text: Column, missing: str = "Unknown") -> Column:
    """Title-case area name; blank becomes ``missing``, NULL stays NULL."""
    name = F.trim(text)
    return F.when(name == "", F.lit(missing)).otherwise(F.initcap(name))


def parse_count(text: Column) -> Column:
    """Non-negative integer; unreadable and negative values become 0."""
    return F.greatest(F.coalesce(text.try_cast("int"), F.lit(0)), F.lit(0))


def age_group(text: Column, marker: str = "PRE", found: str = "PreK", otherwise: str = "School-Age") -> Column:
    """``found`` where the text contains the marker in any case, else (also for NULL) ``otherwise``."""
    return F.when(F.upper(F.trim(text)).contains(marker), F.lit(found)).otherwise(F.lit(otherwise))


def yes_flag(text: Column) -> Column:
    """1 for yes in any case, 0 for anything else, NULL for NULL."""
    return (F.upper(F.trim(text)) == "YES").cast("int")
