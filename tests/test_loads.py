"""Repeated loads, broken lines, stored sketches and layouts, and plans of the distributions."""

import io
import math
import random
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from latewatch import schema
from latewatch.operators import distributions, profile, quality, ranking, sketches, star
from latewatch.operators.features import derive_features
from latewatch.plans import catalog, jobs, loads
from latewatch.session import durable
from latewatch.sources import versions
from latewatch.sources.incidents import incident_records
from latewatch.sources.readers import BROKEN, cause_of, read_checked_records, read_table


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def generated_methods(spark, df):
    """Bytes of the largest method of every stage's generated code; -1 where it could not be compiled."""
    df.collect()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    found = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [found.apply(k)._3().maxMethodCodeSize() for k in range(found.size())]


@pytest.fixture(scope="module")
def clean(spark):
    return durable(catalog.incidents(spark, SMALL))


# ---------------------------------------------------------------- loads


def test_the_first_row_of_a_key_stays(spark, clean, tmp_path):
    folder = f"{tmp_path}/store"
    first, second = clean.filter("busbreakdown_id % 3 <> 0"), clean.withColumn("delay_minutes", F.lit(7.5))
    n, m = first.count(), clean.count()
    assert jobs.add_incidents(first, folder)["fact_incident"] == n
    added = jobs.add_incidents(second, folder)
    assert added["fact_incident"] == m - n and added["dim_boro"] == 0
    store = versions.Store(spark, folder)
    rows = store.table(schema.FACT_INCIDENT)
    assert rows.count() == rows.select("busbreakdown_id").distinct().count() == m
    assert rows.filter("busbreakdown_id % 3 = 0 AND delay_minutes <> 7.5").count() == 0
    old = first.select("busbreakdown_id", "delay_minutes").join(rows.select("busbreakdown_id", F.col("delay_minutes").alias("now")), "busbreakdown_id")
    assert old.count() == n and old.filter("NOT delay_minutes <=> now").count() == 0
    assert store.current().number == 2
    assert set(jobs.add_incidents(second, folder).values()) == {0} and store.current().number == 2


def test_a_lost_writer_leaves_the_version_as_it_was(spark, clean, tmp_path, monkeypatch):
    folder = f"{tmp_path}/store"
    jobs.add_incidents(clean.filter("busbreakdown_id % 2 = 0"), folder)
    before = {t.name: versions.Store(spark, folder).table(t).count() for t in schema.TABLES}

    def lost(*_):
        raise ConnectionError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(versions.Store, "commit", lost)
        with pytest.raises(ConnectionError):
            jobs.add_incidents(clean, folder)
    store = versions.Store(spark, folder)
    assert store.current().number == 1
    assert {t.name: store.table(t).count() for t in schema.TABLES} == before
    jobs.add_incidents(clean, folder)
    assert store.table(schema.FACT_INCIDENT).count() == clean.count()


def test_an_overtaken_writer_begins_again(spark, tmp_path):
    table = schema.Table("t", "k bigint, v string", ("k",))
    store = versions.Store(spark, f"{tmp_path}/store")
    rows = lambda *found: spark.createDataFrame(list(found), "k bigint, v string")
    calls = []

    def frames(version):
        calls.append(version.number)
        if len(calls) == 1:  # another writer is faster
            versions.load_new(store, [table], {"t": rows((1, "theirs"), (2, "theirs"))})
        return {"t": rows((2, "ours"), (3, "ours"), (3, "zzz"), (None, "x"))}

    assert versions.load_new(store, [table], frames) == {"t": 1}
    assert calls == [0, 1]
    assert sorted(map(tuple, store.table(table).collect())) == [(1, "theirs"), (2, "theirs"), (3, "ours")]
    with pytest.raises(versions.Overtaken):
        store.commit(versions.Version(), {"t": "data/none"})
    assert store.current().number == 2


def test_rows_without_parent_are_refused(spark, clean, tmp_path, monkeypatch):
    folder = f"{tmp_path}/store"
    monkeypatch.setattr(star, "date_dimension", lambda features: clean.sparkSession.createDataFrame([], schema.DIM_DATE.schema))
    with pytest.raises(ValueError, match="date_key"):
        jobs.add_incidents(clean, folder)
    assert versions.Store(spark, folder).current().number == 0


def test_members_keep_their_ids(spark, tmp_path):
    keys = lambda *found: spark.createDataFrame([(f,) for f in found], "k string")
    first = durable(ranking.dense_ids(keys("m", "c", None), ["k"], "id"))
    both = star.lasting_ids(keys("m", "a", "z", None, "c"), first, ["k"], "id")
    assert {r.k: r.id for r in both.collect()} == {None: 1, "c": 2, "m": 3, "a": 4, "z": 5}
    empty = star.lasting_ids(keys("b", "a"), first.limit(0), ["k"], "id")
    assert {r.k: r.id for r in empty.collect()} == {"a": 1, "b": 2}

    records = incident_records(spark, SMALL)
    early = records.filter("Bus_Company_Name < 'Operator 15'")
    jobs.ingest(early, f"{tmp_path}/one", sample_rows=0)
    jobs.ingest(records, f"{tmp_path}/two", sample_rows=0, earlier=f"{tmp_path}/one")
    for name, key, id_column in (("operator", "operator", "operator_id"), ("calendar", list(schema.CALENDAR_KEY), "date_id")):
        one, two = (read_table(spark, f"{tmp_path}/{f}/dim_{name}.parquet") for f in ("one", "two"))
        assert one.exceptAll(two).count() == 0 and two.count() > one.count()
        assert two.select(id_column).distinct().count() == two.count() == two.select(key).distinct().count()
    jobs.ingest(early, f"{tmp_path}/two", sample_rows=0, earlier=f"{tmp_path}/two")  # into the same folder
    assert read_table(spark, f"{tmp_path}/two/dim_operator.parquet").count() == two.sparkSession.read.parquet(f"{tmp_path}/two/dim_operator.parquet").count()


# ---------------------------------------------------------------- ingest


def test_ingest_counts_while_it_writes(spark, tmp_path):
    records = incident_records(spark, SMALL)
    report = {r.measure: r.n_rows for r in quality.quality_report(derive_features(records)).collect()}
    context = spark.sparkContext
    jobs_of = []
    for k, features in enumerate((derive_features(records), quality.observed(derive_features(records))[0])):
        context.setJobGroup(f"write-{k}", "")
        features.write.parquet(f"{tmp_path}/{k}")
        jobs_of.append(len(context.statusTracker().getJobIdsForGroup(f"write-{k}")))
    context.setJobGroup("other", "")
    assert jobs_of[0] == jobs_of[1]  # the counts cost no job
    assert jobs.ingest(records, f"{tmp_path}/out", sample_rows=0) == report


def test_broken_lines_are_set_aside(spark, tmp_path):
    head = "a,b,c,d"
    good = ['1,2,3,4', '"x,y",2,"say ""hi""",4', ",,,", '5,"",,']
    bad = {"too few fields": ["1,2,3", "only"], "too many fields": ["1,2,3,4,5", '1,"2,2",3,4,5'], "unclosed quote": ['1,"2,3,4']}
    (tmp_path / "x.csv").write_text("\n".join([head, *good, *[line for lines in bad.values() for line in lines]]) + "\n")
    narrow = schema.struct_of("a string, b string, c string, d string")
    read = durable(read_checked_records(spark, str(tmp_path / "x.csv"), schema=narrow))
    found = read.select("*", cause_of(F.col(BROKEN), 4).alias("cause")).collect()
    assert sorted((r.cause, r[BROKEN]) for r in found if r.cause) == sorted((c, line) for c, lines in bad.items() for line in lines)
    kept = [(r.a, r.b, r.c, r.d) for r in found if not r.cause]
    assert kept == [("1", "2", "3", "4"), ("x,y", "2", 'say "hi"', "4"), (None,) * 4, ("5", None, None, None)]


def test_ingest_loses_no_line_unseen(spark, tmp_path):
    records = incident_records(spark, SMALL)
    records.write.csv(f"{tmp_path}/raw", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    (tmp_path / "raw" / "more.csv").write_text(",".join(schema.RAW_COLUMNS) + "\nshort,line\n" + "x," * 30 + "x\n" + 'a,"b' + ",c" * 25 + "\n")
    accounts = jobs.ingest(read_checked_records(spark, f"{tmp_path}/raw"), f"{tmp_path}/out", sample_rows=0)
    assert [accounts[f"broken: {c}"] for c in ("too few fields", "too many fields", "unclosed quote", "unreadable")] == [1, 1, 1, 0]
    assert accounts["all"] == 1003 and accounts["kept"] == read_table(spark, f"{tmp_path}/out/incidents.parquet").count()
    aside = {r.cause: r.line for r in read_table(spark, f"{tmp_path}/out/quarantine.parquet").collect()}
    assert aside["too few fields"] == "short,line" and len(aside) == 3


# ---------------------------------------------------------------- sketches, density, correlation


def test_merged_sketches_are_near_the_exact_figures(spark):
    rng = random.Random(4)
    rows = [(k % 40, rng.gauss(0, 1) * 10 ** (k % 4), f"v{rng.randrange(9000)}") for k in range(40_000)]
    rows += [(3, float("nan"), None), (41, None, "x")]
    docs = spark.createDataFrame(rows, "day int, v double, s string").repartition(8)
    stored = durable(sketches.sketch_rows(docs, ["day"], ["v"], ["s"]))
    assert stored.count() == 2 * 41
    values = sorted(v for _, v, _ in rows if v is not None and not math.isnan(v))
    found = sketches.quantiles_from(stored, [0.01, 0.25, 0.5, 0.75, 0.99]).first()
    assert found.n == len(values)
    for k, p in enumerate((0.01, 0.25, 0.5, 0.75, 0.99)):
        q = found[f"q_{k}"]
        assert np.searchsorted(values, q, "left") / len(values) - 0.01 < p < np.searchsorted(values, q, "right") / len(values) + 0.01
    counts = {r.column_name: r.n_distinct for r in sketches.distinct_from(stored).collect()}
    exact = {r.column_name: r.n_distinct for r in profile.cardinality(docs.select("s"), ["s"]).collect()}
    assert abs(counts["s"] - exact["s"]) < 0.03 * exact["s"]
    assert abs(counts["v"] - len(set(values)) - 1) < 0.03 * len(values)
    part = sketches.quantiles_from(stored, [0.5], by=["day"]).filter("day = 7").first()
    assert part.n == 1000
    fences = sketches.fences_from(stored).first()
    assert fences.lower < fences.q1 < fences.q3 < fences.upper


def test_approximate_cardinality_is_near_the_exact_one(spark):
    docs = spark.range(30_000).selectExpr("CAST(id % 7000 AS STRING) AS a", "IF(id % 3 = 0, NULL, id) AS b")
    near = {r.column_name: r.n_distinct for r in profile.cardinality(docs, ["a", "b"], approximate=True).collect()}
    exact = {r.column_name: r.n_distinct for r in profile.cardinality(docs, ["a", "b"]).collect()}
    assert all(abs(near[c] - exact[c]) < 0.06 * exact[c] for c in "ab")


def test_binned_density_is_near_the_exact_sum(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(rng.gauss(0, 1) if k % 3 else rng.gauss(8, 0.2),) for k in range(5000)], "v double")
    exact = [r.density for r in distributions.density(docs, "v").collect()]
    binned = [r.density for r in distributions.density(docs, "v", bins_per_width=32).collect()]
    assert len(exact) == len(binned) == 200 and max(abs(a - b) for a, b in zip(exact, binned)) < 1e-4 * max(exact)


def test_correlation_reads_once_and_far_from_zero(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 3))
    x[:, 1] += 0.7 * x[:, 0]
    docs = spark.createDataFrame([tuple(map(float, r)) for r in x + 1e9], "a double, b double, c double")
    got = profile.correlation_matrix(docs, ["a", "b", "c"])
    expected = np.corrcoef((x + 1e9 - 1e9).T)
    for r in got.collect():
        assert abs(r.r - expected["abc".index(r.row_name), "abc".index(r.column_name)]) < 1e-6
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert plan(profile.correlation_matrix(lines, ["l_quantity", "l_discount"])).split("\n\n")[0].count("Scan parquet") == 1


@pytest.mark.parametrize("name", ["delay_histogram", "students_dist", "error_histogram", "delay_kde_binned"])
def test_distributions_compile(spark, name):
    sizes = generated_methods(spark, catalog.CATALOG[name].run(spark, SMALL))
    assert sizes and min(sizes) > 0 and max(sizes) < 8000


# ---------------------------------------------------------------- layouts


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    lines, orders = loads.bucketed_orders(spark, SMALL, 4)
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == lines.count()
