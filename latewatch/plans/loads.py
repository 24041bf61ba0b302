"""Registered queries over repeated loads, broken lines, stored layouts and sketches, and the harder records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.ml import features as ml_features
from latewatch.operators import buckets, distributions, profile, quality, reports, sketches, star
from latewatch.operators.features import derive_features
from latewatch.operators.ranking import dense_ids, value_counts
from latewatch.plans import jobs
from latewatch.plans import oracle as sql
from latewatch.plans import sql as texts
from latewatch.plans.catalog import MIN_N, incidents, register, rounded, table, zoneless
from latewatch.schema import FACT_INCIDENT
from latewatch.session import ensure_checkpoint_dir, staged
from latewatch.sources.incidents import HARD_RULES, incident_records
from latewatch.sources.readers import BROKEN, cause_of, read_checked_records
from latewatch.sources.versions import Store
from latewatch.sources.writers import insert_statements, write_bucketed


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


# ---------------------------------------------------------------- repeated loads

_LATER = "operator < 'OPERATOR 15'"
_LOADED = sql.CLEAN + f""",
early AS (SELECT * FROM clean WHERE busbreakdown_id % 3 <> 0 AND {_LATER}),
late AS (SELECT * REPLACE (delay_minutes + 1 AS delay_minutes) FROM clean WHERE busbreakdown_id % 2 = 0),
""" + ",\n".join(
    f"""old_{d} AS (SELECT {d}, dense_rank() OVER (ORDER BY {d} NULLS FIRST) AS id FROM (SELECT DISTINCT {d} FROM early)),
new_{d} AS (SELECT {d}, dense_rank() OVER (ORDER BY {d} NULLS FIRST) + (SELECT max(id) FROM old_{d}) AS id
            FROM (SELECT {d} FROM late EXCEPT SELECT {d} FROM old_{d})),
ids_{d} AS (SELECT * FROM old_{d} UNION ALL SELECT * FROM new_{d})"""
    for d in ("operator", "reason", "boro")
)
_SECOND = f"""
SELECT {', '.join({'date_key': "strftime(occurred_ts, '%Y-%m-%d') AS date_key", 'occurred_ts': "strftime(occurred_ts, '%Y-%m-%d %H:%M:%S') AS occurred_ts",
                   'operator_id': 'o.id AS operator_id', 'reason_id': 'r.id AS reason_id', 'boro_id': 'b.id AS boro_id'}.get(c, c)
                  for c in FACT_INCIDENT.columns)}
FROM (SELECT * FROM early UNION ALL SELECT * FROM late WHERE busbreakdown_id NOT IN (SELECT busbreakdown_id FROM early)) l
LEFT JOIN ids_operator o ON o.operator = l.operator LEFT JOIN ids_reason r ON r.reason = l.reason
LEFT JOIN ids_boro b ON b.boro = l.boro"""


@register("second_load", sql.over(_LOADED, _SECOND))
def _(spark, sf_dir):
    """Fact rows after two loads that overlap, the second one with other delays."""
    clean = staged(incidents(spark, sf_dir))
    folder = _folder(spark, "loads")
    jobs.add_incidents(clean.filter(f"busbreakdown_id % 3 <> 0 AND {_LATER}"), folder)
    jobs.add_incidents(clean.filter("busbreakdown_id % 2 = 0").withColumn("delay_minutes", F.col("delay_minutes") + 1), folder)
    return Store(spark, folder).table(FACT_INCIDENT)


@register(
    "lasting_ids",
    """WITH early AS (SELECT o_custkey, dense_rank() OVER (ORDER BY o_custkey) AS id FROM (
                       SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < 1994)),
            late AS (SELECT o_custkey, dense_rank() OVER (ORDER BY o_custkey) + (SELECT coalesce(max(id), 0) FROM early) AS id FROM (
                       SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM early))
       SELECT o_custkey, id AS customer_id FROM early UNION ALL SELECT o_custkey, id FROM late""",
)
def _(spark, sf_dir):
    """Ids of customers of the first years, and of those that come later."""
    orders = table(spark, sf_dir, "orders")
    early = orders.filter(F.year("o_orderdate") < 1994).select("o_custkey").distinct()
    stored = staged(dense_ids(early, ["o_custkey"], "customer_id"))
    return star.lasting_ids(orders.select("o_custkey").distinct(), stored, ["o_custkey"], "customer_id")


@register(
    "quarantine",
    """SELECT CASE WHEN event_id % 41 = 0 THEN 'too few fields' WHEN event_id % 43 = 0 THEN 'too many fields'
                   WHEN event_id % 47 = 0 THEN 'unclosed quote' ELSE 'read' END AS cause, count(*) AS n_lines
       FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    """Lines of a file with short, long and unclosed ones among them, by what becomes of them."""
    records = incident_records(spark, sf_dir)
    line = F.to_csv(F.struct(*records.columns), {"escape": '"'})
    key = F.col("Busbreakdown_ID").cast("long")
    broken = (
        F.when(key % 41 == 0, F.regexp_replace(line, ",[^,]*$", ""))
        .when(key % 43 == 0, F.concat(line, F.lit(",more")))
        .when(key % 47 == 0, F.regexp_replace(line, "^([^,]*),", '$1,"'))
        .otherwise(line)
    )
    folder = _folder(spark, "lines")
    records.select(broken.alias("value")).write.text(folder)
    read = staged(read_checked_records(spark, folder, header=False).select("Busbreakdown_ID", BROKEN))
    cause = F.coalesce(cause_of(F.col(BROKEN), len(records.columns)), F.lit("read"))
    return read.groupBy(cause.alias("cause")).agg(F.count("*").alias("n_lines"))


# ---------------------------------------------------------------- layouts


@register(
    "bucketed_join",
    """SELECT o_orderstatus, count(*) AS n_lines, sum(l_quantity) AS quantity, count(DISTINCT o_orderkey) AS n_orders
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def _(spark, sf_dir):
    """Order lines with their orders, from tables bucketed by the order: joined and counted by order without a shuffle."""
    lines, orders = bucketed_orders(spark, sf_dir)
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    return (
        per_order.join(orders.hint("merge"), "o_orderkey")
        .groupBy("o_orderstatus")
        .agg(F.sum("n").alias("n_lines"), F.sum("q").alias("quantity"), F.count("*").alias("n_orders"))
    )


def bucketed_orders(spark: SparkSession, sf_dir: str, n: int = 16) -> tuple[DataFrame, DataFrame]:
    name = uuid.uuid4().hex
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return (
        write_bucketed(lines, f"lines_{name}", ["l_orderkey"], n, _folder(spark, "lines")),
        write_bucketed(orders, f"orders_{name}", ["o_orderkey"], n, _folder(spark, "orders")),
    )


@register(
    "star_join_shuffled",
    sql.over(sql.STAR, "SELECT busbreakdown_id, operator, operator_id, reason, reason_id, boro, boro_id FROM joined"),
)
def _(spark, sf_dir):
    """The star join for dimensions too large to copy: shuffled, with hot keys salted."""
    clean = staged(incidents(spark, sf_dir))
    rows = star.attach_ids(clean, star.build_dimensions(clean), broadcast=False)
    return rows.select("busbreakdown_id", "operator", "operator_id", "reason", "reason_id", "boro", "boro_id")


# ---------------------------------------------------------------- sketches and density

_QUARTERS = (0.25, 0.5, 0.75)


@register(
    "stored_quartiles",
    sql.over(sql.CLEAN, " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS probability, count({c}) AS n, true AS within_one_percent FROM clean"
        for c in profile.NUMERICS for p in _QUARTERS
    )),
)
def _(spark, sf_dir):
    """Quartiles from merged sketches of all months, and whether their exact ranks are within one per cent."""
    clean = staged(incidents(spark, sf_dir).select("year", "month", *profile.NUMERICS))
    path = _folder(spark, "sketches")
    for years in ("year < 2018", "year >= 2018"):
        sketches.add_sketches(sketches.sketch_rows(clean.filter(years), ["year", "month"], profile.NUMERICS), path)
    found = sketches.quantiles_from(spark.read.parquet(path), _QUARTERS)
    points = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"q_{i}").alias("q")) for i, p in enumerate(_QUARTERS)]))
    asked = found.select("column_name", "n", points.alias("a"))  # three rows a column
    ranks = value_counts(clean, profile.NUMERICS).withColumnRenamed("n", "k").join(F.broadcast(asked), "column_name")
    below = F.sum(F.when(F.col("value") < F.col("a.q"), F.col("k")).otherwise(0))
    upto = F.sum(F.when(F.col("value") <= F.col("a.q"), F.col("k")).otherwise(0))
    p, n = F.col("probability"), F.col("n")
    return (
        ranks.groupBy("column_name", "n", F.col("a.p").alias("probability"))
        .agg(below.alias("below"), upto.alias("upto"))
        .select("column_name", "probability", "n", ((F.col("below") <= (p + 0.01) * n) & (F.col("upto") >= (p - 0.01) * n)).alias("within_one_percent"))
    )


@register(
    "stored_distinct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, true AS within_three_percent FROM lineitem HAVING count(*) > 0"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    ),
)
def _(spark, sf_dir):
    """Distinct counts from merged sketches of all ship months against exact ones."""
    columns = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(*columns, F.date_trunc("month", "l_shipdate").alias("by_month"))
    found = sketches.distinct_from(staged(sketches.sketch_rows(lines, ["by_month"], others=columns)))
    exact = profile.cardinality(lines, columns).withColumnRenamed("n_distinct", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return found.join(exact, "column_name").select("column_name", near.alias("within_three_percent"))


_BINS = 32


@register(
    "delay_kde_binned",
    sql.over(sql.CLEAN, f""", facts AS (SELECT count(delay_minutes) AS n, min(delay_minutes) AS lo, max(delay_minutes) AS hi,
                          stddev_samp(delay_minutes) * count(delay_minutes) ** (-0.2) AS h FROM clean),
    places AS (SELECT (delay_minutes - lo) * ({_BINS} / h) AS place, floor((delay_minutes - lo) * ({_BINS} / h)) AS k
               FROM clean, facts WHERE delay_minutes IS NOT NULL),
    shared AS (SELECT k, sum(w) AS w FROM (SELECT k, k + 1 - place AS w FROM places UNION ALL SELECT k + 1, place - k FROM places) GROUP BY 1),
    grid AS (SELECT i AS point, lo + (hi - lo) * i / 199 AS x FROM range(200) g(i), facts)
    SELECT CAST(point AS INT) AS point, round(x, 9) AS x,
           round(sum(w * exp(-0.5 * ((x - lo - k * (h / {_BINS})) / h) ** 2)) / (n * h * sqrt(2 * pi())), 9) AS density
    FROM grid, shared, facts GROUP BY point, x, n, h"""),
)
def _(spark, sf_dir):
    return rounded(distributions.density(incidents(spark, sf_dir), "delay_minutes", bins_per_width=_BINS), 9, "x", "density")


@register(
    "topn_bucket_suppliers",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_suppkey IN (
          SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey NULLS FIRST LIMIT {ml_features.KEPT_OPERATORS})
        THEN CAST(l_suppkey AS VARCHAR) ELSE 'OTHER' END AS l_suppkey_bucketed FROM lineitem""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return buckets.bucket_rare(lines, "l_suppkey", top=ml_features.KEPT_OPERATORS)


# ---------------------------------------------------------------- harder records


def hard_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(derive_features(incident_records(spark, sf_dir, HARD_RULES)))


@register("hard_features", sql.over(sql.hard(sql.FEATURES), "SELECT * FROM features"))
def _(spark, sf_dir):
    return zoneless(derive_features(incident_records(spark, sf_dir, HARD_RULES)))


@register(
    "hard_league",
    sql.over(sql.hard(sql.CLEAN), f"""SELECT operator, count(*) AS incidents, round(avg(delay_minutes), 9) AS avg_delay,
                                      sum(is_breakdown)::BIGINT AS breakdowns FROM clean GROUP BY 1 HAVING count(*) >= {MIN_N}"""),
)
def _(spark, sf_dir):
    measures = {
        "incidents": F.count("*"), "avg_delay": F.round(F.avg("delay_minutes"), 9), "breakdowns": F.sum("is_breakdown").cast("bigint"),
    }
    return reports.grouped(hard_incidents(spark, sf_dir), ["operator"], measures, having=F.col("incidents") >= MIN_N)


@register(
    "hard_star_join",
    sql.over(sql.hard(sql.STAR), "SELECT busbreakdown_id, operator, operator_id, reason, reason_id, boro, boro_id FROM joined"),
)
def _(spark, sf_dir):
    """Half of all rows have one operator: its rows are salted."""
    clean = staged(hard_incidents(spark, sf_dir))
    rows = star.attach_ids(clean, star.build_dimensions(clean), broadcast=False)
    return rows.select("busbreakdown_id", "operator", "operator_id", "reason", "reason_id", "boro", "boro_id")


@register(
    "hard_dump",
    sql.over(sql.hard(sql.STAR), """SELECT 'INSERT INTO dim_operator (operator_id,operator) VALUES (' || CAST(operator_id AS VARCHAR) || ',' ||
        coalesce('''' || replace(operator, '''', '''''') || '''', 'NULL') || ');' AS statement FROM dim_operator"""),
)
def _(spark, sf_dir):
    dimension = star.build_dimensions(hard_incidents(spark, sf_dir))["operator"]
    return insert_statements(dimension, "dim_operator", ["operator_id", "operator"])


@register(
    "hard_param",
    sql.over(sql.hard(sql.CLEAN), """SELECT time_band, count(*) AS incidents FROM clean
                                     WHERE operator = 'O''BRIEN''S COACHES, INC' GROUP BY 1"""),
)
def _(spark, sf_dir):
    return texts.run_query(
        spark, "SELECT time_band, count(*) AS incidents FROM {rows} WHERE operator = :operator GROUP BY time_band",
        {"operator": "O'BRIEN'S COACHES, INC"}, rows=hard_incidents(spark, sf_dir),
    )
