"""Independent SQL statements of the registered queries, for a check against another engine.

Each text reads only the given tables. The incident records are spelled out once and put in
front of the statements that need them.
"""

from __future__ import annotations

RECORDS = r"""
records AS (
    SELECT
        CAST(event_id % 10 + 2014 AS VARCHAR) || '-' || CAST(event_id % 10 + 2015 AS VARCHAR) AS year_text,
        CAST(event_id AS VARCHAR) AS id_text,
        CASE event_id % 4 WHEN 0 THEN 'Special Ed AM Run' WHEN 1 THEN 'Special Ed PM Run'
             WHEN 2 THEN 'General Ed AM Run' ELSE 'Pre-K/EI' END AS run_text,
        CASE WHEN event_id % 60 <> 0 THEN
             CASE event_id % 5 WHEN 0 THEN 'Heavy Traffic' WHEN 1 THEN 'Mechanical Problem'
                  WHEN 2 THEN ' Flat Tire ' WHEN 3 THEN 'Weather Conditions' ELSE 'Other' END
        END AS reason_text,
        CASE WHEN event_id % 101 = 0 THEN 'not a date'
             WHEN event_id % 97 = 0 THEN '01/01/1900 07:00:00 AM'
             ELSE strftime(ts - to_days(CAST(event_id % 3650 AS INT)), '%m/%d/%Y %I:%M:%S %p') END AS when_text,
        CASE WHEN event_id % 58 = 0 THEN NULL WHEN event_id % 59 = 0 THEN '  '
             ELSE CASE user_id % 4 WHEN 0 THEN 'BROOKLYN' WHEN 1 THEN 'Queens'
                       WHEN 2 THEN ' staten island ' ELSE 'Bronx' END END AS area_text,
        CASE WHEN user_id % 20 = 7 THEN ''
             ELSE 'Operator ' || CAST(user_id % 20 AS VARCHAR) || ' Bus Co., Inc. (B'
                  || CAST(user_id AS VARCHAR) || ')' END AS company_text,
        CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '1 HOUR' WHEN 2 THEN '15-30 Min'
             WHEN 3 THEN '0-15 Min' WHEN 4 THEN '1-2 HOURS' WHEN 5 THEN 'half hour'
             WHEN 6 THEN '31 - 45 min' WHEN 7 THEN '4 hrs'
             ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' MINS' END AS delay_text,
        CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 17 = 0 THEN '-2'
             ELSE CAST(user_id % 9 AS VARCHAR) END AS students_text,
        CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS schools_text,
        CASE WHEN event_id % 3 = 0 THEN 'YES ' ELSE 'No' END AS parents_text,
        CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'yes' ELSE 'no' END AS alerted_text,
        CASE WHEN event_id % 211 = 0 THEN 'Unknown' WHEN event_type = 'error' THEN 'Breakdown'
             ELSE 'Running Late' END AS type_text,
        CASE WHEN event_id % 4 = 3 THEN 'Pre-K' ELSE 'School-Age' END AS age_text
    FROM events
)"""

# The harder records: other texts for five of the columns.
HARD_RECORDS = r"""
records AS (
    SELECT
        CAST(event_id % 10 + 2014 AS VARCHAR) || '-' || CAST(event_id % 10 + 2015 AS VARCHAR) AS year_text,
        CAST(event_id AS VARCHAR) AS id_text,
        CASE event_id % 4 WHEN 0 THEN 'Special Ed AM Run' WHEN 1 THEN 'Special Ed PM Run'
             WHEN 2 THEN 'General Ed AM Run' ELSE 'Pre-K/EI' END AS run_text,
        CASE WHEN event_id % 60 <> 0 THEN
             CASE event_id % 5 WHEN 0 THEN 'Heavy Traffic' WHEN 1 THEN 'Mechanical Problem'
                  WHEN 2 THEN ' Flat Tire ' WHEN 3 THEN 'Weather Conditions' ELSE 'Other' END
        END AS reason_text,
        CASE WHEN event_id % 101 = 0 THEN 'not a date'
             WHEN event_id % 97 = 0 THEN '01/01/1900 07:00:00 AM'
             ELSE strftime(ts - to_days(CAST(event_id % 3650 AS INT)), '%m/%d/%Y %I:%M:%S %p') END AS when_text,
        CASE event_id % 6 WHEN 0 THEN 'all   BOROUGHS' WHEN 1 THEN 'nassau county' WHEN 2 THEN ' ' WHEN 3 THEN NULL
             WHEN 4 THEN 'o''neill PARK' ELSE 'Queens' END AS area_text,
        CASE WHEN event_id % 2 = 0 THEN 'Main Line Corp. (B1234)' WHEN event_id % 10 = 1 THEN 'L&M .'
             WHEN event_id % 10 = 3 THEN 'O''Brien''s Coaches, Inc., (B' || CAST(user_id AS VARCHAR) || ') '
             WHEN event_id % 30 = 5 THEN NULL WHEN event_id % 30 = 15 THEN ' (B77) '
             ELSE '  Line ' || CAST(user_id AS VARCHAR) || ' S.A.' END AS company_text,
        CASE event_id % 14 WHEN 0 THEN '200-400 MIN' WHEN 1 THEN '1.5 HOURS' WHEN 2 THEN '20-30-40' WHEN 3 THEN '15-0'
             WHEN 4 THEN '-5' WHEN 5 THEN '  45  ' WHEN 6 THEN '1 hr 30 min' WHEN 7 THEN 'none'
             WHEN 8 THEN '' WHEN 9 THEN '0 - 2 hrs' WHEN 10 THEN '999999999999999999999'
             WHEN 11 THEN NULL WHEN 12 THEN '16min'
             ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(value) AS BIGINT) + 7 AS VARCHAR)
             END AS delay_text,
        CASE event_id % 6 WHEN 0 THEN ' 7 ' WHEN 1 THEN '3.9' WHEN 2 THEN '99999999999' WHEN 3 THEN '' WHEN 4 THEN NULL
             ELSE CAST(user_id % 70 AS VARCHAR) END AS students_text,
        CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS schools_text,
        CASE WHEN event_id % 3 = 0 THEN 'YES ' ELSE 'No' END AS parents_text,
        CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'yes' ELSE 'no' END AS alerted_text,
        CASE WHEN event_id % 211 = 0 THEN 'Unknown' WHEN event_type = 'error' THEN 'Breakdown'
             ELSE 'Running Late' END AS type_text,
        CASE event_id % 5 WHEN 0 THEN ' pre-k ' WHEN 1 THEN NULL WHEN 2 THEN 'EXPRESS' ELSE 'School-Age' END AS age_text
    FROM events
)"""


def hard(prefix: str) -> str:
    """The same expressions over the harder records, whose counts of students have no fraction."""
    counted = "try_cast(CASE WHEN trim(students_text) NOT LIKE '%.%' THEN trim(students_text) END AS INT)"
    return prefix.replace(RECORDS, HARD_RECORDS).replace("try_cast(students_text AS INT)", counted)


FEATURES = (
    RECORDS
    + r""",
read_records AS (
    SELECT *,
        try_strptime(when_text, '%m/%d/%Y %I:%M:%S %p') AS moment,
        upper(trim(delay_text)) AS said,
        regexp_replace(regexp_replace(upper(trim(company_text)), '\s*\(.*$', ''), '[.,]+$', '') AS company
    FROM records
),
timed AS (
    SELECT *,
        CASE
            WHEN try_cast(regexp_extract(said, '(\d+)\s*-\s*(\d+)', 1) AS DOUBLE) > 0
             AND try_cast(regexp_extract(said, '(\d+)\s*-\s*(\d+)', 2) AS DOUBLE) > 0
            THEN (try_cast(regexp_extract(said, '(\d+)\s*-\s*(\d+)', 1) AS DOUBLE)
                  + try_cast(regexp_extract(said, '(\d+)\s*-\s*(\d+)', 2) AS DOUBLE)) / 2.0
            WHEN regexp_matches(said, 'HOUR|HR') THEN try_cast(regexp_extract(said, '(\d+)', 1) AS DOUBLE) * 60.0
            ELSE try_cast(regexp_extract(said, '(\d+)', 1) AS DOUBLE)
        END AS minutes
    FROM read_records
),
features AS (
    SELECT
        try_cast(id_text AS BIGINT) AS busbreakdown_id,
        year_text AS school_year,
        CAST(extract(year FROM moment) AS INT) AS year,
        CAST(extract(month FROM moment) AS INT) AS month,
        CAST(dayofweek(moment) + 1 AS INT) AS day_of_week,
        CAST(extract(hour FROM moment) AS INT) AS hour,
        CASE WHEN extract(hour FROM moment) BETWEEN 6 AND 9 THEN 'AM_Peak'
             WHEN extract(hour FROM moment) BETWEEN 14 AND 17 THEN 'PM_Peak'
             WHEN extract(hour FROM moment) BETWEEN 10 AND 13 THEN 'Midday' ELSE 'OffPeak' END AS time_band,
        CASE WHEN extract(month FROM moment) IN (12, 1, 2) THEN 'Winter'
             WHEN extract(month FROM moment) IN (3, 4, 5) THEN 'Spring'
             WHEN extract(month FROM moment) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
        CAST(dayofweek(moment) IN (0, 6) AS INT) AS is_weekend,
        CASE WHEN company = '' THEN 'UNKNOWN' ELSE company END AS operator,
        CASE WHEN trim(area_text) = '' THEN 'Unknown'
             ELSE array_to_string(list_transform(string_split(lower(trim(area_text)), ' '),
                                                 lambda w: upper(w[1]) || w[2:]), ' ') END AS boro,
        trim(run_text) AS run_type,
        trim(reason_text) AS reason,
        CASE WHEN contains(upper(trim(age_text)), 'PRE') THEN 'PreK' ELSE 'School-Age' END AS school_age,
        greatest(coalesce(try_cast(students_text AS INT), 0), 0) AS students_on_bus,
        CAST(upper(trim(schools_text)) = 'YES' AS INT) AS notified_schools,
        CAST(upper(trim(parents_text)) = 'YES' AS INT) AS notified_parents,
        CAST(upper(trim(alerted_text)) = 'YES' AS INT) AS alerted_opt,
        CASE WHEN minutes > 180 THEN 180.0 WHEN minutes < 0 THEN NULL ELSE minutes END AS delay_minutes,
        CASE WHEN minutes <= 15 THEN 1 ELSE 0 END AS on_time,
        trim(type_text) AS incident_type,
        CAST(trim(type_text) = 'Breakdown' AS INT) AS is_breakdown,
        moment AS occurred_ts
    FROM timed
)"""
)

CLEAN = (
    FEATURES
    + """,
clean AS (
    SELECT * FROM features
    WHERE incident_type IN ('Breakdown', 'Running Late')
      AND occurred_ts IS NOT NULL AND busbreakdown_id IS NOT NULL
      AND year >= 2010 AND year <= 2027
)"""
)

STAR = (
    CLEAN
    + """,
dim_operator AS (SELECT operator, dense_rank() OVER (ORDER BY operator NULLS FIRST) AS operator_id
                 FROM (SELECT DISTINCT operator FROM clean)),
dim_reason AS (SELECT reason, dense_rank() OVER (ORDER BY reason NULLS FIRST) AS reason_id
               FROM (SELECT DISTINCT reason FROM clean)),
dim_boro AS (SELECT boro, dense_rank() OVER (ORDER BY boro NULLS FIRST) AS boro_id
             FROM (SELECT DISTINCT boro FROM clean)),
dim_date AS (SELECT strftime(occurred_ts, '%Y-%m-%d') AS date_key, min(year) AS year, min(month) AS month,
                    min(day_of_week) AS day_of_week, min(season) AS season, min(is_weekend) AS is_weekend,
                    min(school_year) AS school_year
             FROM clean GROUP BY 1),
joined AS (
    SELECT c.*, o.operator_id, r.reason_id, b.boro_id
    FROM clean c LEFT JOIN dim_operator o ON o.operator = c.operator
                 LEFT JOIN dim_reason r ON r.reason = c.reason
                 LEFT JOIN dim_boro b ON b.boro = c.boro
),
fact AS (
    SELECT busbreakdown_id, operator_id, reason_id, boro_id, strftime(occurred_ts, '%Y-%m-%d') AS date_key,
           hour, time_band, run_type, school_age, students_on_bus, notified_schools, notified_parents,
           alerted_opt, delay_minutes, on_time, incident_type, is_breakdown,
           strftime(occurred_ts, '%Y-%m-%d %H:%M:%S') AS occurred_ts
    FROM joined
)"""
)


def share(key: str, seed: int = 42) -> str:
    """Number in [0, 1) from an integer key."""
    step = f"((({key} % 2147483647) + {seed}) * 48271) % 2147483647"
    return f"(({step}) * 48271 % 2147483647) / 2147483647.0::DOUBLE"


def scored(*keys: str, prefix: str = CLEAN) -> str:
    """Test rows with the historical means of their keys learnt from the training rows."""
    columns = ", ".join(keys)
    matches = " AND ".join(f"m.{k} = t.{k}" for k in keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        prefix
        + f""",
sided AS (SELECT *, {share('busbreakdown_id')} < 0.8 AS in_train FROM clean),
means AS (SELECT {columns}, avg(is_breakdown) AS score, avg(delay_minutes) AS expected
          FROM sided WHERE in_train AND {present} GROUP BY {columns}),
overall AS (SELECT avg(is_breakdown) AS score, avg(delay_minutes) AS expected FROM sided WHERE in_train),
scored AS (SELECT t.*, coalesce(m.score, o.score) AS score, coalesce(m.expected, o.expected) AS expected
           FROM sided t LEFT JOIN means m ON {matches} CROSS JOIN overall o WHERE NOT t.in_train)"""
    )


def over(prefix: str, select: str) -> str:
    """A statement behind its common table expressions."""
    return f"WITH {prefix.strip()}\n{select.strip()}"
