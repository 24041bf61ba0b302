"""Raw incident records derived from an event table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from latewatch.schema import RAW_COLUMNS
from latewatch.sources.readers import fill_cores, read_table

# Every event becomes one raw record by these expressions; the columns left out stay NULL.
RECORD_RULES = {
    "School_Year": "concat_ws('-', event_id % 10 + 2014, event_id % 10 + 2015)",
    "Busbreakdown_ID": "cast(event_id AS string)",
    "Run_Type": """
        CASE event_id % 4 WHEN 0 THEN 'Special Ed AM Run' WHEN 1 THEN 'Special Ed PM Run'
                          WHEN 2 THEN 'General Ed AM Run' ELSE 'Pre-K/EI' END""",
    "Reason": """
        CASE WHEN event_id % 60 = 0 THEN NULL ELSE element_at(
            array('Heavy Traffic', 'Mechanical Problem', ' Flat Tire ', 'Weather Conditions', 'Other'),
            cast(event_id % 5 AS int) + 1) END""",
    "Occurred_On": """
        CASE WHEN event_id % 101 = 0 THEN 'not a date'
             WHEN event_id % 97 = 0 THEN '01/01/1900 07:00:00 AM'
             ELSE date_format(ts - make_dt_interval(cast(event_id % 3650 AS int)), 'MM/dd/yyyy hh:mm:ss a') END""",
    "Boro": """
        CASE WHEN event_id % 58 = 0 THEN NULL
             WHEN event_id % 59 = 0 THEN '  '
             ELSE element_at(array('BROOKLYN', 'Queens', ' staten island ', 'Bronx'), cast(user_id % 4 AS int) + 1) END""",
    "Bus_Company_Name": """
        CASE WHEN user_id % 20 = 7 THEN ''
             ELSE concat('Operator ', user_id % 20, ' Bus Co., Inc. (B', user_id, ')') END""",
    "How_Long_Delayed": """
        CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '1 HOUR' WHEN 2 THEN '15-30 Min' WHEN 3 THEN '0-15 Min'
                           WHEN 4 THEN '1-2 HOURS' WHEN 5 THEN 'half hour' WHEN 6 THEN '31 - 45 min' WHEN 7 THEN '4 hrs'
                           ELSE concat(floor(value), ' MINS') END""",
    "Number_Of_Students_On_The_Bus": """
        CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 17 = 0 THEN '-2' ELSE cast(user_id % 9 AS string) END""",
    "Has_Contractor_Notified_Schools": "if(event_id % 2 = 0, 'Yes', 'No')",
    "Has_Contractor_Notified_Parents": "if(event_id % 3 = 0, 'YES ', 'No')",
    "Have_You_Alerted_OPT": "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'yes' ELSE 'no' END",
    "Breakdown_or_Running_Late": """
        CASE WHEN event_id % 211 = 0 THEN 'Unknown' WHEN event_type = 'error' THEN 'Breakdown' ELSE 'Running Late' END""",
    "School_Age_or_PreK": "if(event_id % 4 = 3, 'Pre-K', 'School-Age')",
}


# The same with half of all rows under one name, marks and quotes in names, and delays that are hard to read.
HARD_RULES = RECORD_RULES | {
    "Bus_Company_Name": """
        CASE WHEN event_id % 2 = 0 THEN 'Main Line Corp. (B1234)' WHEN event_id % 10 = 1 THEN 'L&M .'
             WHEN event_id % 10 = 3 THEN concat("O'Brien's Coaches, Inc., (B", user_id, ") ")
             WHEN event_id % 30 = 5 THEN NULL WHEN event_id % 30 = 15 THEN ' (B77) '
             ELSE concat('  Line ', user_id, ' S.A.') END""",
    "How_Long_Delayed": """
        CASE event_id % 14 WHEN 0 THEN '200-400 MIN' WHEN 1 THEN '1.5 HOURS' WHEN 2 THEN '20-30-40' WHEN 3 THEN '15-0'
                           WHEN 4 THEN '-5' WHEN 5 THEN '  45  ' WHEN 6 THEN '1 hr 30 min' WHEN 7 THEN 'none'
                           WHEN 8 THEN '' WHEN 9 THEN '0 - 2 hrs' WHEN 10 THEN '999999999999999999999'
                           WHEN 11 THEN NULL WHEN 12 THEN '16min' ELSE concat(floor(value), '-', floor(value) + 7) END""",
    "Boro": """
        CASE event_id % 6 WHEN 0 THEN 'all   BOROUGHS' WHEN 1 THEN 'nassau county' WHEN 2 THEN ' ' WHEN 3 THEN NULL
                          WHEN 4 THEN "o'neill PARK" ELSE 'Queens' END""",
    "School_Age_or_PreK": "CASE event_id % 5 WHEN 0 THEN ' pre-k ' WHEN 1 THEN NULL WHEN 2 THEN 'EXPRESS' ELSE 'School-Age' END",
    "Number_Of_Students_On_The_Bus": """
        CASE event_id % 6 WHEN 0 THEN ' 7 ' WHEN 1 THEN '3.9' WHEN 2 THEN '99999999999' WHEN 3 THEN '' WHEN 4 THEN NULL
                          ELSE cast(user_id % 70 AS string) END""",
}


def records_from_events(events: DataFrame, rules: Mapping[str, str] = RECORD_RULES) -> DataFrame:
    """Event table to raw incident records (21 string columns)."""
    return events.selectExpr(*[f"{rules.get(c, 'cast(NULL AS string)')} AS {c}" for c in RAW_COLUMNS])


def incident_records(spark: SparkSession, sf_dir: str, rules: Mapping[str, str] = RECORD_RULES) -> DataFrame:
    """Raw incident records over the event table of a data folder."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return records_from_events(fill_cores(read_table(spark, f"{sf_dir}/events.parquet", columns)), rules)
