from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from latewatch import functions as fn


def apply(spark, values, kind, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    out = df.select("i", *[e(F.col("x")).alias(f"y{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(expressions) > 1 else r.y0 for r in out]


DELAYS = {
    "20 MINS": 20, "15-30 Min": 22.5, "1 HOUR": 60, "0-15 Min": 0, "1-2 HOURS": 1.5, "1 hr 30 min": 60,
    "1.5 hours": 60, "45 min/1 hr": 180, "half hour": None, "-5": 5, "": None, "600": 180, "16 - 30": 23,
    "three 3": 180,
}


def test_delay_texts(spark):
    got = apply(spark, [*DELAYS, None], "string", lambda c: fn.winsorize(fn.parse_delay(c)))
    assert got == [*DELAYS.values(), None]


def test_operator_names(spark):
    cases = {
        "Acme Bus, Inc. (B2321)": "ACME BUS, INC", "  ": "UNKNOWN", "": "UNKNOWN", "(B1)": "UNKNOWN",
        "L&M .": "L&M ", "X CO.,": "X CO", None: None,
    }
    assert apply(spark, list(cases), "string", fn.clean_operator) == list(cases.values())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aB ().,\n\t", max_size=12), min_size=200, max_size=300))
def test_one_company_pattern_does_what_two_steps_do(spark, texts):
    def two_steps(c):
        step = F.regexp_replace(F.upper(F.trim(c)), r"\s*\(.*$", "")
        step = F.regexp_replace(step, r"[.,]+$", "")
        return F.when(step == "", "UNKNOWN").otherwise(step)

    for text, (one, two) in zip(texts, apply(spark, texts, "string", fn.clean_operator, two_steps)):
        assert one == two, repr(text)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789-. HhRrOoUumin", max_size=14), min_size=100, max_size=200))
def test_delay_is_bounded(spark, texts):
    for minutes in apply(spark, texts, "string", lambda c: fn.winsorize(fn.parse_delay(c))):
        assert minutes is None or 0 <= minutes <= 180


def test_area_counts_flags_and_ages(spark):
    assert apply(spark, ["  ", None, " staten island ", "BRONX"], "string", fn.clean_area) == [
        "Unknown", None, "Staten Island", "Bronx"]
    assert apply(spark, ["3.7", " 4 ", "abc", "99999999999", "-2", None], "string", fn.parse_count) == [0, 4, 0, 0, 0, 0]
    assert apply(spark, ["YES ", "no", None, "yes"], "string", fn.yes_flag) == [1, 0, None, 1]
    assert apply(spark, ["Pre-K", "School-Age", None], "string", fn.age_group) == ["PreK", "School-Age", "School-Age"]


def test_timestamps(spark):
    got = apply(spark, ["09/03/2019 07:15:00 AM", "09/03/2019 12:15:00 AM", "13/45/2019", ""], "string", fn.parse_timestamp)
    assert got == [datetime(2019, 9, 3, 7, 15), datetime(2019, 9, 3, 0, 15), None, None]


def test_bands_and_seasons_fall_through(spark):
    bands = apply(spark, [6, 9, 10, 13, 14, 17, 18, 5, 0, None], "int", fn.time_band)
    assert bands == ["AM_Peak"] * 2 + ["Midday"] * 2 + ["PM_Peak"] * 2 + ["OffPeak"] * 4
    seasons = apply(spark, [12, 1, 3, 8, 9, None], "int", fn.season)
    assert seasons == ["Winter", "Winter", "Spring", "Summer", "Autumn", "Autumn"]


def test_on_time_and_rounding(spark):
    assert apply(spark, [15.0, 15.5, None], "double", fn.on_time_flag) == [1, 0, 0]
    assert apply(spark, [0.12345, 0.1225, 0.5], "double", fn.percent) == [12.3, 12.2, 50.0]
    assert apply(spark, [0.1, 0.9], "double", fn.capped_risk) == pytest.approx([0.3, 1.0])


def test_parts_of_a_missing_time_are_missing(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert set(df.select(*fn.calendar_parts(F.col("t")).values()).first()) == {None}
