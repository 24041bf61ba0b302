"""SQL surface: fixed texts, every value bound as a parameter.

Frames are named in the text as ``{name}`` and handed over as keyword arguments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from latewatch.operators.joins import sized

OPERATOR_LEAGUE = """
    SELECT operator,
           count(*) AS incidents,
           round(avg(is_breakdown), 3) AS breakdown_rate,
           round(avg(delay_minutes), 1) AS avg_delay_min,
           round(avg(on_time), 3) AS on_time_rate
    FROM {incidents}
    GROUP BY operator
    HAVING incidents >= :min_incidents
    ORDER BY incidents DESC, operator
    LIMIT :top
"""

BAND_SUMMARY = """
    SELECT time_band, count(*) AS incidents, round(avg(delay_minutes), 1) AS avg_delay
    FROM {incidents}
    GROUP BY time_band
    ORDER BY incidents DESC, time_band
"""

# The star queries total the fact table by surrogate key first and look names up afterwards, so
# that one row per key is joined instead of every fact row.
STAR_LEAGUE = """
    WITH totals AS (
        SELECT operator_id,
               count(*) AS incidents,
               round(avg(is_breakdown), 3) AS breakdown_rate,
               round(avg(delay_minutes), 1) AS avg_delay_min
        FROM {fact_incident}
        GROUP BY operator_id
        HAVING incidents >= :min_incidents
    )
    SELECT operator, incidents, breakdown_rate, avg_delay_min
    FROM totals JOIN {dim_operator} USING (operator_id)
    ORDER BY breakdown_rate DESC, operator
"""

AREA_BREAKDOWNS = """
    WITH days AS (
        SELECT date_key, boro_id, count(*) AS n
        FROM {fact_incident}
        WHERE is_breakdown = 1
        GROUP BY date_key, boro_id
    )
    SELECT boro, sum(n) AS breakdowns
    FROM days JOIN {dim_date} USING (date_key) JOIN {dim_boro} USING (boro_id)
    WHERE year = :year
    GROUP BY boro
    ORDER BY breakdowns DESC, boro
"""

OPERATOR_REASONS = """
    SELECT reason, count(*) AS n, round(avg(delay_minutes), 1) AS avg_delay
    FROM {fact_incident} JOIN {dim_operator} USING (operator_id) JOIN {dim_reason} USING (reason_id)
    WHERE operator = :operator
    GROUP BY reason
    ORDER BY n DESC, reason NULLS FIRST
"""

HOURLY_PROFILE = """
    SELECT hour, count(*) AS incidents, round(avg(delay_minutes), 1) AS avg_delay
    FROM {fact_incident}
    GROUP BY hour
    ORDER BY hour
"""

OPERATOR_MATCHES = """
    SELECT count(*) AS matches
    FROM {fact_incident} JOIN {dim_operator} USING (operator_id)
    WHERE operator = ?
"""

SAMPLE_QUERIES = {
    "operator_league": STAR_LEAGUE,
    "area_breakdowns": AREA_BREAKDOWNS,
    "operator_reasons": OPERATOR_REASONS,
    "hourly_profile": HOURLY_PROFILE,
}


def run_query(
    spark: SparkSession,
    text: str,
    parameters: Mapping[str, object] | Sequence[object] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Run a text with named (mapping) or positional (sequence) parameters.

    Parameters become literals of the plan; they never reach the parser as text.
    """
    bound = dict(parameters) if isinstance(parameters, Mapping) else list(parameters or [])
    return spark.sql(text, args=bound or None, **frames)


def star_frames(fact: DataFrame, **dimensions: DataFrame) -> dict[str, DataFrame]:
    """Frames for the star queries; each dimension is marked for broadcast if its size allows.

    Hand in stored or durable dimensions.
    """
    return {"fact_incident": fact, **sized(**dimensions)}


def operator_league(incidents: DataFrame, min_incidents: int = 1000, top: int = 10) -> DataFrame:
    """Operators by volume with breakdown rate, mean delay and on-time rate."""
    return run_query(
        incidents.sparkSession, OPERATOR_LEAGUE, {"min_incidents": min_incidents, "top": top}, incidents=incidents
    )


def band_summary(incidents: DataFrame) -> DataFrame:
    """Volume and mean delay per time band."""
    return run_query(incidents.sparkSession, BAND_SUMMARY, incidents=incidents)
