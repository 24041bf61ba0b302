"""The registered queries: a Spark plan per operator and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.ml import features as ml_features
from latewatch.ml import models as ml_models
from latewatch.operators import buckets, dashboard, distributions, metrics, profile, quality, ranking, reports, split, star
from latewatch.operators.features import derive_features
from latewatch.operators.joins import join_dimension
from latewatch.plans import oracle as sql
from latewatch.plans import sql as texts
from latewatch.schema import CALENDAR_KEY, DIMENSION_IDS, FACT_INCIDENT, FEATURE_COLUMNS
from latewatch.session import durable, spread, staged
from latewatch.sources.incidents import incident_records
from latewatch.sources.readers import read_table, with_timestamp
from latewatch.sources.writers import insert_statements

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """A registered query and its SQL statement."""

    run: Query
    oracle: str | None = None


CATALOG: dict[str, Entry] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        CATALOG[name] = Entry(run, oracle)
        return run

    return add


# Thresholds for the sizes at hand; the operators' defaults are meant for millions of rows.
MIN_N = 100
RISK_KEYS = ("operator", "time_band")
RISK_THRESHOLD = 0.2


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(incident_records(spark, sf_dir))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(all_features(spark, sf_dir))


def zoneless(df: DataFrame, column: str = "occurred_ts") -> DataFrame:
    """Timestamps as other engines store them."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def star_tables(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Analysis rows and dimensions. The records are parsed once, into a stored table that both come from."""
    clean = staged(incidents(spark, sf_dir)) if clean is None else clean
    dimensions = star.build_dimensions(clean)
    return star.feature_table(clean, dimensions), dimensions


def star_views(spark: SparkSession, sf_dir: str, *keys: str) -> dict[str, DataFrame]:
    rows, dimensions = star_tables(spark, sf_dir)
    named = {f"dim_{key}": dimensions[key] for key in keys}
    return texts.star_frames(star.fact_table(rows), **named)


def scored_rows(spark: SparkSession, sf_dir: str, *keys: str, clean: DataFrame | None = None) -> DataFrame:
    """Test rows with historical breakdown risk (``score``) and delay (``expected``)."""
    train, test = split.hash_split(incidents(spark, sf_dir) if clean is None else clean)
    return metrics.score_by_history(
        train, test, keys or RISK_KEYS, {"score": "is_breakdown", "expected": "delay_minutes"}
    )


def judged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_rows(spark, sf_dir)
    return rows.withColumn("prediction", (F.col("score") >= RISK_THRESHOLD).cast("double"))


def residual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_rows(spark, sf_dir).filter(F.col("delay_minutes").isNotNull())
    columns = fn.residual_columns(F.col("delay_minutes"), F.col("expected"))
    return rows.select(
        "busbreakdown_id",
        F.col("delay_minutes").alias("actual"),
        F.col("expected").alias("prediction"),
        *[column.alias(name) for name, column in columns.items()],
    )


RESIDUALS = sql.scored(*RISK_KEYS) + """,
residuals AS (SELECT busbreakdown_id, delay_minutes AS actual, expected AS prediction,
                     delay_minutes - expected AS residual, abs(delay_minutes - expected) AS abs_error
              FROM scored WHERE delay_minutes IS NOT NULL)"""


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round figures whose last digits depend on the order of additions."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- scans


@register("parquet_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/events.parquet")


@register("pruned_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf_dir):
    orders = read_table(spark, f"{sf_dir}/orders.parquet")
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@register(
    "repartition_key",
    sql.over(sql.CLEAN, "SELECT operator, count(*) AS n_rows, sum(is_breakdown)::BIGINT AS breakdowns FROM clean GROUP BY operator"),
)
def _(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("operator", "is_breakdown")
    return spread(rows, None, "operator").groupBy("operator").agg(
        F.count("*").alias("n_rows"), F.sum("is_breakdown").alias("breakdowns")
    )


# ---------------------------------------------------------------- scalar expressions


def _raw(expressions: Callable[[], dict[str, Column]]) -> Query:
    """Record id plus expressions over the raw records."""

    def run(spark, sf_dir):
        return incident_records(spark, sf_dir).select(
            F.col("Busbreakdown_ID").alias("id_text"), *[c.alias(n) for n, c in expressions().items()]
        )

    return run


def _occurred() -> Column:
    return fn.parse_timestamp(F.col("Occurred_On"))


def _parts() -> dict[str, Column]:
    return fn.calendar_parts(_occurred())


def _delay() -> Column:
    return fn.parse_delay(F.col("How_Long_Delayed"))

CATALOG["parse_timestamp"] = Entry(
    _raw(lambda: {"occurred_ts": _occurred().cast("timestamp_ntz")}),
    sql.over(sql.FEATURES, "SELECT id_text, moment AS occurred_ts FROM timed"),
)
CATALOG["calendar_parts"] = Entry(
    _raw(_parts),
    sql.over(sql.FEATURES, """SELECT CAST(busbreakdown_id AS VARCHAR) AS id_text, hour, day_of_week, month, year, is_weekend
                              FROM features"""),
)
CATALOG["time_band"] = Entry(
    _raw(lambda: {"hour": _parts()["hour"], "time_band": fn.time_band(_parts()["hour"])}),
    sql.over(sql.FEATURES, "SELECT CAST(busbreakdown_id AS VARCHAR) AS id_text, hour, time_band FROM features"),
)
CATALOG["season"] = Entry(
    _raw(lambda: {"month": _parts()["month"], "season": fn.season(_parts()["month"])}),
    sql.over(sql.FEATURES, "SELECT CAST(busbreakdown_id AS VARCHAR) AS id_text, month, season FROM features"),
)
CATALOG["delay_parse"] = Entry(
    _raw(lambda: {"delay_text": F.col("How_Long_Delayed"), "minutes": _delay()}),
    sql.over(sql.FEATURES, "SELECT id_text, delay_text, minutes FROM timed"),
)
CATALOG["winsorize"] = Entry(
    _raw(lambda: {"minutes": _delay(), "delay_minutes": fn.winsorize(_delay())}),
    sql.over(sql.FEATURES, """SELECT id_text, minutes, CASE WHEN minutes > 180 THEN 180.0 WHEN minutes < 0 THEN NULL
                              ELSE minutes END AS delay_minutes FROM timed"""),
)
CATALOG["clean_operator"] = Entry(
    _raw(
        lambda: {
            "company_text": F.col("Bus_Company_Name"),
            "operator": fn.clean_operator(F.col("Bus_Company_Name")),
        }
    ),
    sql.over(sql.FEATURES, """SELECT id_text, company_text, CASE WHEN company = '' THEN 'UNKNOWN' ELSE company END AS operator
                              FROM timed"""),
)
CATALOG["clean_boro"] = Entry(
    _raw(lambda: {"boro": fn.clean_area(F.col("Boro")), "reason": F.trim("Reason"), "run_type": F.trim("Run_Type")}),
    sql.over(sql.FEATURES, "SELECT CAST(busbreakdown_id AS VARCHAR) AS id_text, boro, reason, run_type FROM features"),
)
CATALOG["parse_count"] = Entry(
    _raw(
        lambda: {
            "students_text": F.col("Number_Of_Students_On_The_Bus"),
            "students_on_bus": fn.parse_count(F.col("Number_Of_Students_On_The_Bus")),
        }
    ),
    sql.over(sql.RECORDS, """SELECT id_text, students_text, greatest(coalesce(try_cast(students_text AS INT), 0), 0)
                             AS students_on_bus FROM records"""),
)
CATALOG["school_age"] = Entry(
    _raw(
        lambda: {"age_text": F.col("School_Age_or_PreK"), "school_age": fn.age_group(F.col("School_Age_or_PreK"))}
    ),
    sql.over(sql.RECORDS, """SELECT id_text, age_text, CASE WHEN upper(trim(age_text)) LIKE '%PRE%' THEN 'PreK'
                             ELSE 'School-Age' END AS school_age FROM records"""),
)
CATALOG["yes_no_flags"] = Entry(
    _raw(
        lambda: {
            "notified_schools": fn.yes_flag(F.col("Has_Contractor_Notified_Schools")),
            "notified_parents": fn.yes_flag(F.col("Has_Contractor_Notified_Parents")),
            "alerted_opt": fn.yes_flag(F.col("Have_You_Alerted_OPT")),
        }
    ),
    sql.over(sql.FEATURES, """SELECT CAST(busbreakdown_id AS VARCHAR) AS id_text, notified_schools, notified_parents,
                              alerted_opt FROM features"""),
)


@register(
    "labels",
    sql.over(sql.FEATURES, "SELECT busbreakdown_id, school_year, incident_type, is_breakdown, delay_minutes, on_time FROM features"),
)
def _(spark, sf_dir):
    return all_features(spark, sf_dir).select(
        "busbreakdown_id", "school_year", "incident_type", "is_breakdown", "delay_minutes", "on_time"
    )


@register("features", sql.over(sql.FEATURES, "SELECT * FROM features"))
def _(spark, sf_dir):
    return zoneless(all_features(spark, sf_dir))


@register(
    "date_key",
    sql.over(sql.CLEAN, """SELECT busbreakdown_id, strftime(occurred_ts, '%Y-%m-%d') AS date_key,
                           strftime(occurred_ts, '%Y-%m-%d %H:%M:%S') AS occurred_text FROM clean"""),
)
def _(spark, sf_dir):
    ts = F.col("occurred_ts")
    return incidents(spark, sf_dir).select(
        "busbreakdown_id", fn.date_key(ts).alias("date_key"), ts.cast("string").alias("occurred_text")
    )


# ---------------------------------------------------------------- quality


@register("quality_filter", sql.over(sql.CLEAN, "SELECT * FROM clean"))
def _(spark, sf_dir):
    return zoneless(incidents(spark, sf_dir))


@register(
    "quality_report",
    sql.over(
        sql.FEATURES,
        """, marks AS (
            SELECT coalesce(incident_type IN ('Breakdown', 'Running Late'), false) AS good_type,
                   occurred_ts IS NOT NULL AS good_time, busbreakdown_id IS NOT NULL AS good_id,
                   occurred_ts IS NULL OR year BETWEEN 2010 AND 2027 AS good_year
            FROM features),
        lines AS (
            SELECT 'all' AS measure, count(*) AS n_rows FROM marks
            UNION ALL SELECT 'kept', count(*) FROM marks WHERE good_type AND good_time AND good_id AND good_year
            UNION ALL SELECT 'dropped', count(*) FROM marks WHERE NOT (good_type AND good_time AND good_id AND good_year)
            UNION ALL SELECT 'bad_incident_type', count(*) FROM marks WHERE NOT good_type
            UNION ALL SELECT 'bad_timestamp', count(*) FROM marks WHERE NOT good_time
            UNION ALL SELECT 'bad_record_id', count(*) FROM marks WHERE NOT good_id
            UNION ALL SELECT 'bad_year', count(*) FROM marks WHERE NOT good_year)
        SELECT measure, n_rows, n_rows * 100.0::DOUBLE / (SELECT count(*) FROM marks) AS percent FROM lines""",
    ),
)
def _(spark, sf_dir):
    return quality.quality_report(all_features(spark, sf_dir))


@register(
    "pk_dedupe",
    sql.over(
        sql.CLEAN,
        """SELECT operator, hour, busbreakdown_id, occurred_ts FROM (
             SELECT *, row_number() OVER (PARTITION BY operator, hour ORDER BY occurred_ts, busbreakdown_id) AS place
             FROM clean) WHERE place = 1""",
    ),
)
def _(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("operator", "hour", "busbreakdown_id", "occurred_ts")
    return zoneless(quality.first_per_key(rows, ["operator", "hour"], ["occurred_ts", "busbreakdown_id"]))


_LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


@register(
    "pk_dedupe_lines",
    f"""SELECT {_LINE_COLUMNS} FROM (SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                   l_shipdate) AS place FROM lineitem) WHERE place = 1""",
)
def _(spark, sf_dir):
    columns = _LINE_COLUMNS.split(", ")
    return quality.first_per_key(table(spark, sf_dir, "lineitem").select(*columns), columns[:2], columns[2:])


@register(
    "not_null_reject",
    sql.over(sql.STAR, """SELECT 'kept' AS side, boro, boro_id FROM dim_boro WHERE boro IS NOT NULL
                          UNION ALL SELECT 'rejected', boro, boro_id FROM dim_boro WHERE boro IS NULL"""),
)
def _(spark, sf_dir):
    dimension = star.build_dimensions(incidents(spark, sf_dir), {"boro": "boro_id"})["boro"]
    kept, rejected = quality.split_required(dimension, ["boro_id", "boro"])
    return (
        kept.withColumn("side", F.lit("kept"))
        .unionByName(rejected.withColumn("side", F.lit("rejected")))
        .select("side", "boro", "boro_id")
    )


@register(
    "fk_orphans",
    sql.over(
        sql.STAR,
        """SELECT 'operator_id' AS foreign_key, count(*) AS n_orphans FROM fact
             WHERE operator_id IS NOT NULL AND operator_id NOT IN (SELECT operator_id FROM dim_operator)
           UNION ALL SELECT 'reason_id', count(*) FROM fact
             WHERE reason_id IS NOT NULL AND reason_id NOT IN (SELECT reason_id FROM dim_reason)
           UNION ALL SELECT 'boro_id', count(*) FROM fact
             WHERE boro_id IS NOT NULL AND boro_id NOT IN (SELECT boro_id FROM dim_boro)
           UNION ALL SELECT 'date_key', count(*) FROM fact
             WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dim_date WHERE date_key IS NOT NULL)""",
    ),
)
def _(spark, sf_dir):
    clean = staged(incidents(spark, sf_dir))
    rows, dimensions = star_tables(spark, sf_dir, clean)
    parents = {
        "operator_id": (dimensions["operator"], "operator_id"),
        "reason_id": (dimensions["reason"], "reason_id"),
        "boro_id": (dimensions["boro"], "boro_id"),
        "date_key": (star.date_dimension(clean), "date_key"),
    }
    return quality.orphan_counts(star.fact_table(rows), parents)


@register(
    "fk_orphan_lines",
    """SELECT 'l_orderkey' AS foreign_key, count(*) AS n_orphans FROM lineitem
         WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL SELECT 'l_partkey', count(*) FROM lineitem
         WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
       UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem
         WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(spark, sf_dir):
    return quality.orphan_counts(
        table(spark, sf_dir, "lineitem"),
        {
            "l_orderkey": (table(spark, sf_dir, "orders"), "o_orderkey"),
            "l_partkey": (table(spark, sf_dir, "part"), "p_partkey"),
            "l_suppkey": (table(spark, sf_dir, "supplier"), "s_suppkey"),
        },
    )


@register(
    "fk_orphan_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return quality.orphans(lines, table(spark, sf_dir, "part"), "l_partkey", "p_partkey")


# ---------------------------------------------------------------- star schema


@register(
    "dims",
    sql.over(
        sql.STAR,
        """SELECT 'operator' AS dimension, operator AS value, operator_id AS id FROM dim_operator
           UNION ALL SELECT 'reason', reason, reason_id FROM dim_reason
           UNION ALL SELECT 'boro', boro, boro_id FROM dim_boro""",
    ),
)
def _(spark, sf_dir):
    dimensions = star.build_dimensions(incidents(spark, sf_dir))
    named = [
        dimensions[key].select(F.lit(key).alias("dimension"), F.col(key).alias("value"), F.col(id_column).alias("id"))
        for key, id_column in DIMENSION_IDS.items()
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


_CALENDAR = ", ".join(CALENDAR_KEY)


@register(
    "dim_calendar",
    sql.over(
        sql.CLEAN,
        f"""SELECT {_CALENDAR}, row_number() OVER (
              ORDER BY {', '.join(c + ' NULLS FIRST' for c in CALENDAR_KEY)}) AS date_id
            FROM (SELECT DISTINCT {_CALENDAR} FROM clean)""",
    ),
)
def _(spark, sf_dir):
    return star.calendar_dimension(incidents(spark, sf_dir))


@register("dim_date", sql.over(sql.STAR, "SELECT * FROM dim_date"))
def _(spark, sf_dir):
    return star.date_dimension(incidents(spark, sf_dir))


@register(
    "star_join",
    sql.over(sql.STAR, "SELECT busbreakdown_id, operator, operator_id, reason, reason_id, boro, boro_id FROM joined"),
)
def _(spark, sf_dir):
    rows, _ = star_tables(spark, sf_dir)
    return rows.select("busbreakdown_id", "operator", "operator_id", "reason", "reason_id", "boro", "boro_id")


_FACT = ", ".join(FACT_INCIDENT.columns)


@register("fact_incident", sql.over(sql.STAR, f"SELECT {_FACT} FROM fact"))
def _(spark, sf_dir):
    rows, _ = star_tables(spark, sf_dir)
    return star.fact_table(rows)


def _dump_literal(name: str, kind: str) -> str:
    text = f"'''' || replace({name}, '''', '''''') || ''''" if kind == "text" else f"CAST({name} AS VARCHAR)"
    return f"coalesce({text}, 'NULL')"


_TEXT_COLUMNS = {"date_key", "time_band", "run_type", "school_age", "incident_type", "occurred_ts"}
_DUMP = " || ',' || ".join(
    _dump_literal(c, "text" if c in _TEXT_COLUMNS else "number") for c in FACT_INCIDENT.columns
)


@register(
    "insert_dump",
    sql.over(
        sql.STAR,
        f"SELECT 'INSERT INTO fact_incident ({','.join(FACT_INCIDENT.columns)}) VALUES (' || {_DUMP} || ');' AS statement FROM fact",
    ),
)
def _(spark, sf_dir):
    rows, _ = star_tables(spark, sf_dir)
    return insert_statements(star.fact_table(rows), "fact_incident")


# ---------------------------------------------------------------- reports


def _report(name: str, run: Callable[[DataFrame], DataFrame], statement: str) -> None:
    CATALOG[name] = Entry(lambda spark, sf_dir: run(incidents(spark, sf_dir)), sql.over(sql.CLEAN, statement))


_report("class_balance", reports.class_balance, "SELECT incident_type, count(*) AS cnt FROM clean GROUP BY 1")
_report("global_rates", reports.global_rates, "SELECT avg(is_breakdown) AS breakdown_rate, avg(on_time) AS on_time_rate FROM clean")
_report(
    "by_reason",
    reports.by_reason,
    "SELECT reason, count(*) AS incidents FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 12",
)
_report("by_hour", reports.by_hour, "SELECT hour, count(*) AS incidents FROM clean WHERE hour IS NOT NULL GROUP BY 1")
_report(
    "type_by_timeband",
    reports.type_by_band,
    "SELECT time_band, incident_type, count(*) AS cnt FROM clean GROUP BY 1, 2",
)
_report(
    "operator_breakdown_rate",
    lambda df: reports.operators_by_breakdown_rate(df, min_n=MIN_N),
    f"""SELECT operator, count(*) AS incidents, avg(is_breakdown) AS breakdown_rate FROM clean GROUP BY 1
        HAVING count(*) >= {MIN_N} ORDER BY 3 DESC, 1 NULLS FIRST LIMIT 15""",
)
_report(
    "by_boro",
    reports.by_boro,
    "SELECT boro, count(*) AS incidents FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10",
)
_report(
    "monthly_trend",
    reports.monthly_trend,
    """SELECT year, month, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
       count(*) AS incidents FROM clean WHERE year IS NOT NULL GROUP BY 1, 2""",
)
_report(
    "operator_league",
    lambda df: texts.operator_league(df, min_incidents=MIN_N),
    f"""SELECT operator, count(*) AS incidents, round(avg(is_breakdown), 3) AS breakdown_rate,
        round(avg(delay_minutes), 1) AS avg_delay_min, round(avg(on_time), 3) AS on_time_rate
        FROM clean GROUP BY 1 HAVING count(*) >= {MIN_N} ORDER BY 2 DESC, 1 LIMIT 10""",
)
_report(
    "operator_volume",
    reports.operator_volume,
    """SELECT operator, count(*) AS incidents, avg(is_breakdown) AS breakdown_rate, avg(delay_minutes) AS avg_delay
       FROM clean GROUP BY 1""",
)
_report(
    "timeband_summary",
    texts.band_summary,
    "SELECT time_band, count(*) AS incidents, round(avg(delay_minutes), 1) AS avg_delay FROM clean GROUP BY 1",
)
_report(
    "delay_by_hour",
    lambda df: reports.average_delay_by(df, "hour"),
    "SELECT hour, avg(delay_minutes) AS avg_delay FROM clean WHERE hour IS NOT NULL GROUP BY 1",
)
_report(
    "delay_rush",
    reports.delay_by_rush,
    """SELECT rush, CASE WHEN rush THEN 'Rush Hour' ELSE 'Non-Rush Hour' END AS label, avg(delay_minutes) AS avg_delay
       FROM (SELECT time_band IN ('AM_Peak', 'PM_Peak') AS rush, delay_minutes FROM clean) GROUP BY rush""",
)
_report(
    "top_operators",
    reports.top_operators,
    "SELECT operator, count(*) AS n FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10",
)
_report(
    "delay_by_runtype",
    lambda df: reports.delay_by_run_type(df, above=MIN_N),
    f"""SELECT run_type, avg(delay_minutes) AS avg_delay, count(*) AS n FROM clean GROUP BY 1 HAVING count(*) > {MIN_N}
        ORDER BY 2 DESC NULLS LAST, 1 NULLS FIRST LIMIT 8""",
)
_report(
    "delay_by_dow",
    reports.delay_by_weekday,
    """SELECT day_of_week, min(strftime(occurred_ts, '%a')) AS dow, avg(delay_minutes) AS avg_delay FROM clean
       WHERE day_of_week IS NOT NULL GROUP BY 1""",
)
_report(
    "delay_by_timeband",
    reports.delay_by_band,
    """SELECT p.position, p.time_band, avg(delay_minutes) AS avg_delay
       FROM (VALUES (0, 'AM_Peak'), (1, 'Midday'), (2, 'PM_Peak'), (3, 'OffPeak')) AS p(position, time_band)
       LEFT JOIN clean USING (time_band) GROUP BY 1, 2""",
)
_report(
    "breakdown_by_boro",
    lambda df: reports.breakdown_rate_by_boro(df, above=MIN_N),
    f"""SELECT boro, avg(is_breakdown) AS rate, count(*) AS n FROM clean WHERE boro IS NOT NULL GROUP BY 1
        HAVING count(*) > {MIN_N} ORDER BY 2 DESC, 1 LIMIT 10""",
)
_report(
    "yearly_type_pivot",
    reports.types_by_year,
    """SELECT year, count(*) FILTER (incident_type = 'Running Late') AS running_late,
       count(*) FILTER (incident_type = 'Breakdown') AS breakdown
       FROM clean WHERE year BETWEEN 2015 AND 2026 GROUP BY 1""",
)
_report(
    "type_share",
    reports.type_share,
    """SELECT sum(is_breakdown)::BIGINT AS breakdowns, (count(*) - sum(is_breakdown))::BIGINT AS others,
       sum(is_breakdown)::DOUBLE / count(*) AS breakdown_share FROM clean""",
)

# ---------------------------------------------------------------- SQL over the star schema


@register(
    "q1_league",
    sql.over(
        sql.STAR,
        f"""SELECT o.operator, count(*) AS incidents, round(avg(f.is_breakdown), 3) AS breakdown_rate,
            round(avg(f.delay_minutes), 1) AS avg_delay_min
            FROM fact f JOIN dim_operator o ON o.operator_id = f.operator_id GROUP BY 1 HAVING count(*) >= {MIN_N}""",
    ),
)
def _(spark, sf_dir):
    views = star_views(spark, sf_dir, "operator")
    return texts.run_query(spark, texts.STAR_LEAGUE, {"min_incidents": MIN_N}, **views)


@register(
    "q2_boro_breakdowns",
    sql.over(
        sql.STAR,
        """SELECT b.boro, count(*) AS breakdowns FROM fact f JOIN dim_boro b ON b.boro_id = f.boro_id
           JOIN dim_date d ON d.date_key = f.date_key WHERE f.is_breakdown = 1 AND d.year = 2019 GROUP BY 1""",
    ),
)
def _(spark, sf_dir):
    views = star_views(spark, sf_dir, "boro")
    views["dim_date"] = star.date_dimension(incidents(spark, sf_dir))
    return texts.run_query(spark, texts.AREA_BREAKDOWNS, {"year": 2019}, **views)


_OPERATOR = "OPERATOR 3 BUS CO., INC"


@register(
    "q3_operator_reasons",
    sql.over(
        sql.STAR,
        f"""SELECT r.reason, count(*) AS n, round(avg(f.delay_minutes), 1) AS avg_delay FROM fact f
            JOIN dim_reason r ON r.reason_id = f.reason_id JOIN dim_operator o ON o.operator_id = f.operator_id
            WHERE o.operator = '{_OPERATOR}' GROUP BY 1""",
    ),
)
def _(spark, sf_dir):
    views = star_views(spark, sf_dir, "operator", "reason")
    return texts.run_query(spark, texts.OPERATOR_REASONS, {"operator": _OPERATOR}, **views)


@register(
    "q4_hourly",
    sql.over(sql.STAR, "SELECT hour, count(*) AS incidents, round(avg(delay_minutes), 1) AS avg_delay FROM fact GROUP BY 1"),
)
def _(spark, sf_dir):
    fact = star.fact_table(incidents(spark, sf_dir).withColumns({c: F.lit(None).cast("bigint") for c in DIMENSION_IDS.values()}))
    return texts.run_query(spark, texts.HOURLY_PROFILE, fact_incident=fact)


_MALICIOUS = "x'; DROP TABLE fact_incident; --"


@register(
    "param_query",
    sql.over(
        sql.STAR,
        f"""SELECT 'malicious' AS case_name, count(*) AS matches FROM fact JOIN dim_operator USING (operator_id)
              WHERE operator = '{_MALICIOUS.replace("'", "''")}'
            UNION ALL SELECT 'benign', count(*) FROM fact JOIN dim_operator USING (operator_id) WHERE operator = '{_OPERATOR}'
            UNION ALL SELECT 'intact', count(*) FROM fact""",
    ),
)
def _(spark, sf_dir):
    views = star_views(spark, sf_dir, "operator")
    cases = [
        texts.run_query(spark, texts.OPERATOR_MATCHES, [value], **views).select(F.lit(name).alias("case_name"), "matches")
        for name, value in (("malicious", _MALICIOUS), ("benign", _OPERATOR))
    ]
    intact = views["fact_incident"].agg(F.count("*").alias("matches")).select(F.lit("intact").alias("case_name"), "matches")
    return cases[0].unionByName(cases[1]).unionByName(intact)


# ---------------------------------------------------------------- profile and distributions

_FEATURE_NAMES = [c for c in FEATURE_COLUMNS if c not in DIMENSION_IDS.values()]

_report(
    "null_counts",
    profile.null_counts,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_nulls FROM clean" for c in _FEATURE_NAMES
    ),
)
_CARDINALITY = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_distinct FROM (SELECT DISTINCT {c} FROM clean)" for c in profile.CATEGORICALS
)
_report("cardinality", profile.cardinality, _CARDINALITY)
_report(
    "numeric_profile",
    lambda df: rounded(profile.numeric_profile(df), 6, "mean", "std", "skew", "kurt"),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
            max(x) AS max, round(avg((x - m) ** 3) / avg((x - m) ** 2) ** 1.5, 6) AS skew, round(kurtosis_pop(x), 6) AS kurt
            FROM (SELECT CAST({c} AS DOUBLE) AS x FROM clean), (SELECT avg({c}) AS m FROM clean)"""
        for c in profile.NUMERICS
    ),
)
_report(
    "quantiles",
    lambda df: ranking.quantiles(df, profile.NUMERICS).withColumnsRenamed({"q_0": "q25", "q_1": "median", "q_2": "q75"}),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q25,
            quantile_disc(CAST({c} AS DOUBLE), 0.5) AS median, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q75 FROM clean"""
        for c in profile.NUMERICS
    ),
)
_report(
    "iqr_outliers",
    lambda df: profile.outlier_fences(df, ["delay_minutes", "students_on_bus"]),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower,
            q3 + 1.5::DOUBLE * (q3 - q1) AS upper,
            count(*) FILTER (x < q1 - 1.5::DOUBLE * (q3 - q1) OR x > q3 + 1.5::DOUBLE * (q3 - q1)) AS n_outliers
            FROM (SELECT CAST({c} AS DOUBLE) AS x FROM clean),
                 (SELECT quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3 FROM clean)
            GROUP BY q1, q3"""
        for c in ("delay_minutes", "students_on_bus")
    ),
)
_report(
    "correlation_matrix",
    lambda df: rounded(profile.correlation_matrix(df), 9, "r"),
    " UNION ALL ".join(
        f"""SELECT '{a}' AS row_name, '{b}' AS column_name,
            round({f'CASE WHEN stddev_pop(coalesce({a}, 0)) > 0 THEN 1.0::DOUBLE END' if a == b
                   else f'corr(coalesce({a}, 0), coalesce({b}, 0))'}, 9) AS r FROM clean"""
        for a in profile.CORRELATED
        for b in profile.CORRELATED
    ),
)


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""
        SELECT CAST(k AS INT) AS bin, round(lo + (k - 1) * (hi - lo) / {bins}, 9) AS low_edge,
               round(lo + k * (hi - lo) / {bins}, 9) AS high_edge, count(b) AS n
        FROM (SELECT unnest(range(1, {bins} + 1)) AS k)
        CROSS JOIN (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source})
        LEFT JOIN (SELECT least(floor((x - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS b
                   FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL),
                        (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source})) ON b = k
        GROUP BY k, lo, hi"""


def _histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    return rounded(distributions.histogram(df, column, bins), 9, "low_edge", "high_edge")


_report("delay_histogram", lambda df: _histogram(df, "delay_minutes", 40), _histogram_sql("clean", "delay_minutes", 40))
_SEATED = "(SELECT * FROM clean WHERE students_on_bus > 0 AND students_on_bus < 60)"
_report(
    "students_dist",
    lambda df: _histogram(df.filter("students_on_bus > 0 AND students_on_bus < 60"), "students_on_bus", 30),
    _histogram_sql(_SEATED, "students_on_bus", 30),
)
_report(
    "delay_centre",
    lambda df: rounded(distributions.centre_marks(df, "delay_minutes"), 9, "mean", "median"),
    """SELECT 'delay_minutes' AS column_name, count(delay_minutes) AS n, round(avg(delay_minutes), 9) AS mean,
       round(quantile_cont(delay_minutes, 0.5), 9) AS median FROM clean""",
)
_report(
    "students_centre",
    lambda df: rounded(
        distributions.centre_marks(df.filter("students_on_bus > 0 AND students_on_bus < 60"), "students_on_bus"),
        9, "mean", "median",
    ),
    f"""SELECT 'students_on_bus' AS column_name, count(*) AS n, round(avg(students_on_bus), 9) AS mean,
        round(quantile_cont(CAST(students_on_bus AS DOUBLE), 0.5), 9) AS median FROM {_SEATED}""",
)
_report(
    "delay_kde",
    lambda df: rounded(distributions.density(df, "delay_minutes"), 9, "x", "density"),
    """, facts AS (SELECT count(delay_minutes) AS n, min(delay_minutes) AS lo, max(delay_minutes) AS hi,
                          stddev_samp(delay_minutes) * count(delay_minutes) ** (-0.2) AS h FROM clean),
    weights AS (SELECT delay_minutes AS v, count(*) AS w FROM clean WHERE delay_minutes IS NOT NULL GROUP BY 1),
    grid AS (SELECT i AS point, lo + (hi - lo) * i / 199 AS x FROM range(200) g(i), facts)
    SELECT CAST(point AS INT) AS point, round(x, 9) AS x,
           round(sum(w * exp(-0.5 * ((x - v) / h) ** 2)) / (n * h * sqrt(2 * pi())), 9) AS density
    FROM grid, weights, facts GROUP BY point, x, n, h""",
)

# ---------------------------------------------------------------- dashboard

_YEARS, _BANDS, _BORO = (2016, 2022), ("AM_Peak", "PM_Peak", "Midday"), "Queens"
_SELECTED = sql.CLEAN + f""",
picked AS (SELECT * FROM clean WHERE year BETWEEN {_YEARS[0]} AND {_YEARS[1]}
           AND time_band IN ('AM_Peak', 'PM_Peak', 'Midday'))"""


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.select_incidents(with_timestamp(incidents(spark, sf_dir)), _YEARS, _BANDS)


def _dash(name: str, run: Callable[[DataFrame], DataFrame], statement: str) -> None:
    CATALOG[name] = Entry(lambda spark, sf_dir: run(_selected(spark, sf_dir)), sql.over(_SELECTED, statement))


@register(
    "dash_filter",
    sql.over(_SELECTED, f"SELECT busbreakdown_id, year, time_band, boro, occurred_ts FROM picked WHERE boro = '{_BORO}'"),
)
def _(spark, sf_dir):
    rows = dashboard.select_incidents(with_timestamp(incidents(spark, sf_dir)), _YEARS, _BANDS, _BORO)
    return zoneless(rows.select("busbreakdown_id", "year", "time_band", "boro", "occurred_ts"))


_report(
    "filter_options",
    dashboard.filter_options,
    """SELECT DISTINCT 'year' AS filter, CAST(year AS VARCHAR) AS choice FROM clean WHERE year IS NOT NULL
       UNION ALL SELECT DISTINCT 'boro', boro FROM clean WHERE boro IS NOT NULL
       UNION ALL SELECT DISTINCT 'operator', operator FROM clean WHERE operator IS NOT NULL""",
)
_dash(
    "dash_kpi",
    dashboard.key_figures,
    """SELECT count(*) AS incidents, avg(is_breakdown) * 100 AS breakdown_percent, avg(delay_minutes) AS avg_delay,
       avg(on_time) * 100 AS on_time_percent FROM picked""",
)
_dash("dash_by_boro", dashboard.counts_by_boro, "SELECT boro, count(*) AS incidents FROM picked WHERE boro IS NOT NULL GROUP BY 1")
_dash(
    "dash_by_reason",
    dashboard.counts_by_reason,
    "SELECT reason, count(*) AS incidents FROM picked WHERE reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
_dash("dash_by_hour", dashboard.counts_by_hour, "SELECT hour, count(*) AS incidents FROM picked WHERE hour IS NOT NULL GROUP BY 1")
_dash(
    "dash_league",
    lambda df: dashboard.league(df, min_n=MIN_N),
    f"""SELECT operator, incidents, round_even(rate * 100, 1) AS breakdown_rate, round_even(delay, 1) AS avg_delay
        FROM (SELECT operator, count(*) AS incidents, avg(is_breakdown) AS rate, avg(delay_minutes) AS delay
              FROM picked WHERE operator IS NOT NULL GROUP BY 1 HAVING count(*) >= {MIN_N}
              ORDER BY rate DESC, operator LIMIT 15)""",
)
_GRID = """SELECT operator, time_band, count(*) AS incidents, avg(is_breakdown) AS risk,
           least(1.0::DOUBLE, avg(is_breakdown) * 3.0::DOUBLE) AS gauge FROM clean"""
_report("risk_lookup", dashboard.risk_grid, f"{_GRID} WHERE operator IS NOT NULL AND time_band IS NOT NULL GROUP BY 1, 2")
_report(
    "risk_point",
    lambda df: dashboard.risk_lookup(df, _OPERATOR, "PM_Peak"),
    f"{_GRID} WHERE operator = '{_OPERATOR}' AND time_band = 'PM_Peak' GROUP BY 1, 2",
)

# ---------------------------------------------------------------- splits, buckets, weights


@register(
    "hash_split",
    sql.over(sql.CLEAN, f"""SELECT busbreakdown_id, CASE WHEN {sql.share('busbreakdown_id')} < 0.8 THEN 'train' ELSE 'test' END AS side
                            FROM clean"""),
)
def _(spark, sf_dir):
    train, test = split.hash_split(incidents(spark, sf_dir).select("busbreakdown_id"))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


_report(
    "hash_sample",
    lambda df: split.hash_sample(df.select("busbreakdown_id", "delay_minutes"), 0.15),
    f"SELECT busbreakdown_id, delay_minutes FROM clean WHERE {sql.share('busbreakdown_id', 1)} < 0.15",
)
_report(
    "topn_bucket",
    lambda df: buckets.bucket_rare(df.select("busbreakdown_id", "operator"), "operator", top=ml_features.KEPT_OPERATORS),
    """SELECT busbreakdown_id, operator, CASE WHEN operator IN (
         SELECT operator FROM clean GROUP BY 1 ORDER BY count(*) DESC, operator NULLS FIRST LIMIT 25)
       THEN operator ELSE 'OTHER' END AS operator_bucketed FROM clean""",
)
_report(
    "class_weights",
    buckets.class_weight_row,
    """SELECT count(*) AS n, sum(is_breakdown)::BIGINT AS n_pos, count(*) / (2.0::DOUBLE * sum(is_breakdown)) AS w_pos,
       count(*) / (2.0::DOUBLE * (count(*) - sum(is_breakdown))) AS w_neg FROM clean""",
)

# ---------------------------------------------------------------- scores


@register(
    "risk_score",
    sql.over(sql.scored(*RISK_KEYS), "SELECT busbreakdown_id, operator, time_band, is_breakdown, score FROM scored"),
)
def _(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("busbreakdown_id", "operator", "time_band", "is_breakdown", "score")


_JUDGED = sql.scored(*RISK_KEYS) + f""",
judged AS (SELECT *, CASE WHEN score >= {RISK_THRESHOLD} THEN 1 ELSE 0 END AS prediction FROM scored),
cells AS (SELECT count(*) FILTER (is_breakdown = 1 AND prediction = 1)::DOUBLE AS tp,
                 count(*) FILTER (is_breakdown = 0 AND prediction = 1)::DOUBLE AS fp,
                 count(*) FILTER (is_breakdown = 1 AND prediction = 0)::DOUBLE AS fn,
                 count(*) FILTER (is_breakdown = 0 AND prediction = 0)::DOUBLE AS tn FROM judged)"""


@register(
    "confusion_matrix",
    sql.over(_JUDGED, """SELECT is_breakdown AS label, count(*) FILTER (prediction = 0) AS predicted_0,
                         count(*) FILTER (prediction = 1) AS predicted_1 FROM judged GROUP BY 1"""),
)
def _(spark, sf_dir):
    return metrics.confusion_matrix(judged_rows(spark, sf_dir), "is_breakdown", "prediction")


@register(
    "cls_scores",
    sql.over(
        _JUDGED,
        """SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision_breakdown,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall_breakdown,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1_breakdown,
           round((coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)
                  + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) * (tn + fp)) / (tp + fp + fn + tn), 9) AS f1_weighted
           FROM cells""",
    ),
)
def _(spark, sf_dir):
    scores = metrics.classification_scores(judged_rows(spark, sf_dir), "is_breakdown", "prediction")
    return rounded(scores, 9, *scores.columns)


_CURVE = sql.scored(*RISK_KEYS) + """,
steps AS (SELECT score, sum(is_breakdown)::BIGINT AS pos, (count(*) - sum(is_breakdown))::BIGINT AS neg FROM scored GROUP BY 1),
curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                 sum(pos) OVER () AS p, sum(neg) OVER () AS n
          FROM steps WINDOW w AS (ORDER BY score DESC))"""


@register(
    "roc_curve",
    sql.over(
        _CURVE,
        """SELECT score AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, tp::DOUBLE / p AS tpr, fp::DOUBLE / n AS fpr FROM curve
           UNION ALL SELECT NULL, 0, 0, 0.0, 0.0""",
    ),
)
def _(spark, sf_dir):
    return metrics.roc_curve(scored_rows(spark, sf_dir), "is_breakdown", "score")


@register(
    "auc_exact",
    sql.over(
        _CURVE,
        """SELECT round(sum(neg * (2 * tp - pos) / 2.0::DOUBLE) / (max(p)::DOUBLE * max(n)), 9) AS roc_auc,
           round(sum(pos * (tp / (tp + fp)::DOUBLE
                 + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0)::DOUBLE, tp / (tp + fp)::DOUBLE)) / 2) / max(p), 9) AS pr_auc
           FROM curve""",
    ),
)
def _(spark, sf_dir):
    return rounded(metrics.area_under_curves(scored_rows(spark, sf_dir), "is_breakdown", "score"), 9, "roc_auc", "pr_auc")


@register(
    "reg_scores",
    sql.over(
        RESIDUALS,
        """SELECT round(sqrt(avg(residual ** 2)), 9) AS rmse, round(avg(abs_error), 9) AS mae,
           round(1 - avg(residual ** 2) / var_pop(actual), 9) AS r2 FROM residuals""",
    ),
)
def _(spark, sf_dir):
    scores = metrics.regression_scores(scored_rows(spark, sf_dir), "delay_minutes", "expected")
    return rounded(scores, 9, "rmse", "mae", "r2")


@register("residuals", sql.over(RESIDUALS, "SELECT * FROM residuals"))
def _(spark, sf_dir):
    return residual_rows(spark, sf_dir)


@register("residual_mean", sql.over(RESIDUALS, "SELECT round(avg(residual), 6) AS mean_residual, count(*) AS n FROM residuals"))
def _(spark, sf_dir):
    row = residual_rows(spark, sf_dir).agg(F.avg("residual").alias("mean_residual"), F.count("*").alias("n"))
    return rounded(row, 6, "mean_residual")


@register("error_histogram", sql.over(RESIDUALS, _histogram_sql("residuals", "abs_error", 40)))
def _(spark, sf_dir):
    return _histogram(residual_rows(spark, sf_dir), "abs_error", 40)


@register(
    "residual_box",
    sql.over(
        RESIDUALS,
        """SELECT 'residual' AS column_name, q1, median, q3,
           min(residual) FILTER (residual BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
           max(residual) FILTER (residual BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
           count(*) FILTER (residual NOT BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS n_fliers
           FROM residuals, (SELECT quantile_disc(residual, 0.25) AS q1, quantile_disc(residual, 0.5) AS median,
                            quantile_disc(residual, 0.75) AS q3 FROM residuals) GROUP BY q1, median, q3""",
    ),
)
def _(spark, sf_dir):
    return distributions.box_figures(residual_rows(spark, sf_dir), "residual")


_QQ_VALUES = ", ".join(
    f"({i}, {p!r}::DOUBLE, {z!r}::DOUBLE)" for i, (p, z) in enumerate(distributions.normal_places(99))
)


@register(
    "residual_qq",
    sql.over(
        RESIDUALS,
        f""", places(point, p, theoretical) AS (VALUES {_QQ_VALUES}),
        ranks AS (SELECT residual, row_number() OVER (ORDER BY residual) AS place, count(*) OVER () AS n FROM residuals),
        pairs AS (SELECT point, theoretical, min(residual) AS observed FROM places JOIN ranks ON place >= p * n GROUP BY 1, 2)
        SELECT point, round(theoretical, 9) AS theoretical, observed,
               round((SELECT regr_slope(observed, theoretical) FROM pairs), 6) AS slope,
               round((SELECT regr_intercept(observed, theoretical) FROM pairs), 6) AS intercept FROM pairs""",
    ),
)
def _(spark, sf_dir):
    points = distributions.normal_quantile_points(residual_rows(spark, sf_dir), "residual")
    return rounded(rounded(points, 9, "theoretical"), 6, "slope", "intercept")


@register(
    "actual_vs_pred",
    sql.over(
        RESIDUALS,
        """SELECT CAST(least(floor(actual / 9.0) + 1, 20) AS INT) AS x_bin, CAST(least(floor(prediction / 9.0) + 1, 20) AS INT) AS y_bin,
           count(*) AS n FROM residuals GROUP BY 1, 2""",
    ),
)
def _(spark, sf_dir):
    return distributions.joint_histogram(residual_rows(spark, sf_dir), "actual", "prediction", 0, 180, bins=20)


# Predictors of different grain, compared by their delay error and breakdown ranking.
_GRAINS = {"operator": ("operator",), "time_band": ("time_band",), "operator_and_band": RISK_KEYS}


def _grain_sql(name: str, keys: tuple[str, ...]) -> str:
    body = sql.scored(*keys, prefix="").lstrip(",\n ")
    return f"""SELECT * FROM (WITH {body.strip()}
        SELECT '{name}' AS model, sqrt(avg((delay_minutes - expected) ** 2)) AS rmse,
               count(DISTINCT ({', '.join(keys)}))::DOUBLE AS n_groups FROM scored WHERE delay_minutes IS NOT NULL)"""


@register(
    "model_ranking",
    sql.over(
        sql.CLEAN,
        f""", results AS ({' UNION ALL '.join(_grain_sql(n, k) for n, k in _GRAINS.items())})
        SELECT model, round(rmse, 9) AS rmse, n_groups, round(rmse / n_groups, 9) AS quality_per_cost,
               n_groups / (SELECT min(n_groups) FROM results) AS relative_cost,
               rmse = (SELECT min(rmse) FROM results) AS is_best FROM results""",
    ),
)
def _(spark, sf_dir):
    used = ["busbreakdown_id", "operator", "time_band", "is_breakdown", "delay_minutes"]
    clean, results = staged(incidents(spark, sf_dir).select(*used)), None
    for name, keys in _GRAINS.items():
        rows = scored_rows(spark, sf_dir, *keys, clean=clean).filter(F.col("delay_minutes").isNotNull())
        row = rows.agg(
            F.sqrt(F.avg(F.pow(F.col("delay_minutes") - F.col("expected"), F.lit(2.0)))).alias("rmse"),
            F.count_distinct(*keys).cast("double").alias("n_groups"),
        ).select(F.lit(name).alias("model"), "rmse", "n_groups")
        results = row if results is None else results.unionByName(row)
    results = durable(results)  # three rows, read for the best one and for the ranking
    best = metrics.best_model(results, "rmse", larger_is_better=False).select("model").scalar()
    ranked = metrics.rank_models(results, "rmse", "n_groups", larger_is_better=False)
    return rounded(ranked.withColumn("is_best", F.col("model") == best), 9, "rmse", "quality_per_cost")


# ---------------------------------------------------------------- machine learning


_INDEXED = ml_features.DELAY_MINUTES.categorical


def _indexed_sql() -> str:
    ranks = ", ".join(
        f"""rank_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS place
                         FROM bucketed WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in _INDEXED
    )
    places = ", ".join(f"coalesce(rank_{c}.place, (SELECT count(*) FROM rank_{c}))::DOUBLE AS {c}_idx" for c in _INDEXED)
    joins = " ".join(f"LEFT JOIN rank_{c} ON rank_{c}.{c} = bucketed.{c}" for c in _INDEXED)
    return f""", bucketed AS (
        SELECT *, CASE WHEN operator IN (
          SELECT operator FROM clean GROUP BY 1 ORDER BY count(*) DESC, operator NULLS FIRST LIMIT {ml_features.KEPT_OPERATORS})
          THEN operator ELSE 'OTHER' END AS operator_bucketed FROM clean), {ranks}
        SELECT busbreakdown_id, {places} FROM bucketed {joins}"""


@register("indexed", sql.over(sql.CLEAN, _indexed_sql()))
def _(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("busbreakdown_id", "operator", *[c for c in _INDEXED if c != "operator_bucketed"])
    bucketed = buckets.bucket_rare(rows, "operator", ml_features.KEPT_OPERATORS)
    found = ml_features.with_level_index(bucketed, ml_features.level_table(bucketed, _INDEXED), _INDEXED)
    return found.select("busbreakdown_id", *[f"{c}_idx" for c in _INDEXED])


@register("cls_metrics")
def _(spark, sf_dir):
    return ml_models.results_frame(ml_models.compare_classifiers(ml_features.prepare_risk(incidents(spark, sf_dir))))


@register("reg_metrics")
def _(spark, sf_dir):
    return ml_models.results_frame(ml_models.compare_regressors(ml_features.prepare_delay(incidents(spark, sf_dir))))


@register("feature_importance")
def _(spark, sf_dir):
    prepared = ml_features.prepare_delay(incidents(spark, sf_dir))
    forest = {"Random Forest": ml_models.regressors()["Random Forest"]}
    return ml_models.importances(ml_models.compare_regressors(prepared, forest), "Random Forest")


@register("cv_metrics")
def _(spark, sf_dir):
    train, _ = split.hash_split(ml_features.prepare_risk(incidents(spark, sf_dir)))
    _, summary = ml_models.tune_logistic(train)
    return spark.createDataFrame(summary["settings"])


# ---------------------------------------------------------------- the same operators on order data


@register(
    "supplier_league",
    f"""SELECT s_name, n, round(return_rate, 9) AS return_rate, avg_quantity FROM (
          SELECT l_suppkey, count(*) AS n, avg(CAST(l_returnflag = 'R' AS INT)) AS return_rate, avg(l_quantity) AS avg_quantity
          FROM lineitem GROUP BY 1 HAVING count(*) >= {MIN_N}) JOIN supplier ON s_suppkey = l_suppkey
        ORDER BY return_rate DESC, s_name LIMIT 15""",
)
def _(spark, sf_dir):
    totals = reports.grouped(
        table(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        {
            "n": F.count("*"),
            "return_rate": F.avg((F.col("l_returnflag") == "R").cast("int")),
            "avg_quantity": F.avg("l_quantity"),
        },
        having=F.col("n") >= MIN_N,
    )
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named = join_dimension(totals, names, "l_suppkey", how="inner")
    top = named.orderBy(F.desc("return_rate"), "s_name").limit(15)
    return rounded(top, 9, "return_rate").select("s_name", "n", "return_rate", "avg_quantity")


@register(
    "order_trend",
    """SELECT year, month, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period, count(*) AS incidents
       FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return reports.monthly_trend(orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")))


@register(
    "order_price_quantiles",
    """SELECT 'o_totalprice' AS column_name, count(*) AS n, quantile_disc(o_totalprice, 0.01) AS q_0,
       quantile_disc(o_totalprice, 0.25) AS q_1, quantile_disc(o_totalprice, 0.5) AS q_2,
       quantile_disc(o_totalprice, 0.75) AS q_3, quantile_disc(o_totalprice, 0.99) AS q_4 FROM orders""",
)
def _(spark, sf_dir):
    return ranking.quantiles(table(spark, sf_dir, "orders"), ["o_totalprice"], [0.01, 0.25, 0.5, 0.75, 0.99])


@register(
    "order_price_profile",
    """SELECT 'o_totalprice' AS column_name, round(avg(o_totalprice), 2) AS mean, round(stddev_samp(o_totalprice), 2) AS std,
       min(o_totalprice) AS min, max(o_totalprice) AS max,
       round(avg((o_totalprice - m) ** 3) / avg((o_totalprice - m) ** 2) ** 1.5, 6) AS skew,
       round(kurtosis_pop(o_totalprice), 6) AS kurt FROM orders, (SELECT avg(o_totalprice) AS m FROM orders)""",
)
def _(spark, sf_dir):
    row = profile.numeric_profile(table(spark, sf_dir, "orders"), ["o_totalprice"])
    return rounded(rounded(row, 2, "mean", "std"), 6, "skew", "kurt")


@register("line_price_histogram", _histogram_sql("lineitem", "l_extendedprice", 40))
def _(spark, sf_dir):
    return _histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 40)


@register(
    "order_ranks",
    """SELECT o_custkey, o_orderdate, row_number() OVER (ORDER BY o_custkey, o_orderdate) AS rank_id
       FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)""",
)
def _(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate").distinct()
    return ranking.dense_ids(keys, ["o_custkey", "o_orderdate"], "rank_id")


@register(
    "nation_orders",
    """SELECT n_name, count(*) AS orders, count(DISTINCT o_custkey) AS customers
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       WHERE year(o_orderdate) = 1997 GROUP BY 1""",
)
def _(spark, sf_dir):
    return texts.run_query(
        spark,
        """SELECT n_name, sum(n) AS orders, count(*) AS customers
           FROM (SELECT o_custkey, count(*) AS n FROM {orders}
                 WHERE o_orderdate >= make_date(:year, 1, 1) AND o_orderdate < make_date(:year + 1, 1, 1)
                 GROUP BY o_custkey)
           JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
           GROUP BY n_name""",
        {"year": 1997},
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


# More queries are registered there.
from latewatch.plans import loads  # noqa: E402, F401
