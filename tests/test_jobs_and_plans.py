import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from latewatch import schema
from latewatch.operators import dashboard, quality, reports, star
from latewatch.operators.features import derive_features
from latewatch.plans import catalog, jobs, sql
from latewatch.session import TIMINGS, durable, ensure_checkpoint_dir, partition_report, spread, timed
from latewatch.sources import writers
from latewatch.sources.incidents import incident_records
from latewatch.sources.readers import fill_cores, read_records, read_table, register, with_timestamp


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_csv_rules(spark, tmp_path):
    lines = ["School_Year,Busbreakdown_ID,Run_Type", "1,,x", '2,"",y', "3,  ,z", '4,"A, ""B"" Inc",w', "5", "6,a,b,extra"]
    (tmp_path / "raw.csv").write_text("\n".join(lines))
    narrow = schema.struct_of("a string, b string, c string")
    rows = {r.a: (r.b, r.c) for r in read_records(spark, str(tmp_path / "raw.csv"), schema=narrow).collect()}
    assert rows == {
        "1": (None, "x"), "2": (None, "y"), "3": ("  ", "z"), "4": ('A, "B" Inc', "w"), "5": (None, None), "6": ("a", "b"),
    }
    with pytest.raises(FileNotFoundError):
        read_records(spark, str(tmp_path / "x.csv"), str(tmp_path / "y.csv"))


def test_csv_and_direct_records_agree(spark, stored):
    # An empty text comes back from CSV as a missing one.
    direct = incident_records(spark, SMALL).replace("", None)
    back = read_records(spark, f"{stored[0]}/raw.csv")
    assert back.columns == list(schema.RAW_COLUMNS)
    key = lambda df: sorted(map(repr, derive_features(df).drop("occurred_ts").collect()))
    assert key(direct) == key(back)


def test_ingest_accounts_and_layout(spark, stored, incidents):
    folder, accounts = stored
    assert accounts["kept"] + accounts["dropped"] == accounts["all"] == 1000
    assert incidents.count() == accounts["kept"]
    assert {f.name: f.dataType for f in incidents.schema} == {f.name: f.dataType for f in schema.FEATURE_SCHEMA}
    for key, id_column in schema.DIMENSION_IDS.items():
        dimension = read_table(spark, f"{folder}/dim_{key}.parquet")
        row = dimension.agg(F.count("*").alias("n"), F.count_distinct(id_column).alias("ids")).first()
        assert row.n == row.ids == dimension.distinct().count()
        assert incidents.filter(F.col(key).isNull() & F.col(id_column).isNotNull()).count() == 0
    assert spark.read.csv(f"{folder}/sample.csv", header=True).count() == 50
    # The year is a folder, so that a year range skips files.
    assert "PartitionFilters: [isnotnull(year" in plan(dashboard.select_incidents(incidents, (2016, 2018)))


def test_profile_document(incidents):
    document = jobs.profile_document(incidents)
    assert document["n_rows"] == incidents.count()
    assert document["null_counts"]["delay_minutes"] == incidents.filter("delay_minutes IS NULL").count()
    assert document["cardinality"]["time_band"] == 4
    stats = document["stats"]["delay_minutes"]
    assert stats["q25"] <= stats["median"] <= stats["q75"] <= stats["max"] == 180


def test_relational_load_queries_and_injection(spark, stored, incidents, tmp_path):
    dimensions = star.build_dimensions(incidents)
    rows = jobs.load_relational(incidents, dimensions, str(tmp_path))
    assert rows["fact_incident"] == incidents.count()
    assert rows["dim_boro"] == incidents.filter("boro IS NOT NULL").select("boro").distinct().count()
    answers = jobs.star_queries(spark, str(tmp_path), min_incidents=10, operator="OPERATOR 3 BUS CO., INC")
    assert set(answers) == set(sql.SAMPLE_QUERIES)
    assert answers["operator_league"].count() > 0 and answers["hourly_profile"].count() == 24
    assert "BroadcastHashJoin" in plan(answers["operator_reasons"])
    fact, operators = (read_table(spark, f"{tmp_path}/{n}.parquet") for n in ("fact_incident", "dim_operator"))
    for value in ("x'; DROP TABLE fact_incident; --", "' OR '1'='1"):
        assert sql.run_query(spark, sql.OPERATOR_MATCHES, [value], fact_incident=fact, dim_operator=operators).first()[0] == 0
    assert fact.count() == rows["fact_incident"]


def test_broken_foreign_keys_are_reported(incidents, tmp_path):
    dimensions = star.build_dimensions(incidents)
    dimensions["reason"] = dimensions["reason"].filter("reason <> 'Other'")
    with pytest.raises(ValueError, match="reason_id"):
        jobs.load_relational(incidents, dimensions, str(tmp_path))


def test_sql_dump(spark, incidents, tmp_path):
    tables = jobs.relational_tables(incidents, star.build_dimensions(incidents))
    writers.write_dump(tables, schema.TABLES, str(tmp_path), fact_rows=25)
    ddl = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/schema").collect())
    assert ddl.count("CREATE TABLE") == 5 and "FOREIGN KEY (boro_id) REFERENCES dim_boro (boro_id)" in ddl
    facts = [r.value for r in spark.read.text(f"{tmp_path}/fact_incident").collect()]
    assert len(facts) == 25 and all(f.startswith("INSERT INTO fact_incident (busbreakdown_id,") for f in facts)
    quoted = writers.insert_statements(spark.createDataFrame([("O'Neil", None, 1.5)], "a string, b int, c double"), "t")
    assert quoted.first().statement == "INSERT INTO t (a,b,c) VALUES ('O''Neil',NULL,1.5);"


def test_ids_do_not_depend_on_partitioning(spark, incidents):
    ids = [
        {k: sorted(map(tuple, d.collect()), key=str) for k, d in star.build_dimensions(df).items()}
        for df in (incidents, incidents.repartition(3))
    ]
    assert ids[0] == ids[1]


def test_session_helpers(spark, incidents):
    assert ensure_checkpoint_dir(spark).endswith(spark.sparkContext.getCheckpointDir().rsplit("/", 1)[-1])
    assert durable(incidents.select("boro").distinct()).count() > 3
    with timed("count"):
        total = incidents.count()
    assert TIMINGS["count"] > 0
    assert sum(r.rows for r in partition_report(spread(incidents, 4, "operator")).collect()) == total
    assert fill_cores(spark.read.parquet(f"{SMALL}/events.parquet")).rdd.getNumPartitions() >= 8
    register(incidents, "known_incidents")
    assert spark.table("known_incidents").count() == total
    texts = incidents.select(F.col("occurred_ts").cast("string").alias("occurred_ts"))
    assert dict(with_timestamp(texts).dtypes)["occurred_ts"] == "timestamp"


def test_null_keys_are_kept_or_dropped_as_asked(incidents):
    missing = incidents.filter("boro IS NULL").count()
    kept = sum(r.incidents for r in reports.count_by(incidents, "boro").collect())
    dropped = sum(r.incidents for r in dashboard.counts_by_boro(incidents).collect())
    assert missing > 0 and kept == incidents.count() and dropped == kept - missing


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.CATALOG["pruned_scan"].run(spark, SMALL))
    assert "EqualTo(o_orderstatus,F)" in text
    schema_read = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_totalprice" in schema_read and "o_custkey" not in schema_read and "o_orderdate" not in schema_read


def test_plans_have_the_intended_shape(spark, incidents):
    league = plan(sql.operator_league(incidents))
    assert league.count("Exchange") <= 4 and "TakeOrderedAndProject" in league
    first = plan(quality.first_per_key(incidents, ["operator"], ["occurred_ts", "busbreakdown_id"]))
    assert "WindowGroupLimit" in first
    joined = plan(catalog.CATALOG["star_join"].run(spark, SMALL))
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined
