"""Raw records to the analysis table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.schema import DIMENSION_IDS, FEATURE_COLUMNS


def derive_features(raw: DataFrame, *kept: str) -> DataFrame:
    """Clean and type every used column of the raw records; ``kept`` columns are passed on.

    Stacked projections, each deriving from the one before, so that no text is parsed twice and the
    code generated for a row stays small enough to be compiled. Surrogate ids come with the star join.
    """
    parsed = raw.select(
        "*",
        fn.parse_timestamp(F.col("Occurred_On")).alias("occurred_ts"),
        fn.winsorize(fn.parse_delay(F.col("How_Long_Delayed"))).alias("delay_minutes"),
        F.trim("Breakdown_or_Running_Late").alias("incident_type"),
    )
    dated = parsed.select("*", *[c.alias(name) for name, c in fn.calendar_parts(F.col("occurred_ts")).items()])
    derived: dict[str, Column] = {
        "busbreakdown_id": F.col("Busbreakdown_ID").try_cast("bigint"),
        "school_year": F.col("School_Year"),
        "time_band": fn.time_band(F.col("hour")),
        "season": fn.season(F.col("month")),
        "operator": fn.clean_operator(F.col("Bus_Company_Name")),
        "boro": fn.clean_area(F.col("Boro")),
        "run_type": F.trim("Run_Type"),
        "reason": F.trim("Reason"),
        "school_age": fn.age_group(F.col("School_Age_or_PreK")),
        "students_on_bus": fn.parse_count(F.col("Number_Of_Students_On_The_Bus")),
        "notified_schools": fn.yes_flag(F.col("Has_Contractor_Notified_Schools")),
        "notified_parents": fn.yes_flag(F.col("Has_Contractor_Notified_Parents")),
        "alerted_opt": fn.yes_flag(F.col("Have_You_Alerted_OPT")),
        "on_time": fn.on_time_flag(F.col("delay_minutes")),
        "is_breakdown": fn.type_flag(F.col("incident_type")),
    }
    ids = set(DIMENSION_IDS.values())
    return dated.select(
        *[derived.get(name, F.col(name)).alias(name) for name in FEATURE_COLUMNS if name not in ids], *kept
    )
