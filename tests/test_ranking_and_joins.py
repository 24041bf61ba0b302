import random

import pytest
from pyspark.sql import functions as F

from latewatch.operators import distributions, joins, profile, quality, ranking, split


def test_dense_ids_equal_a_sort(spark):
    rng = random.Random(1)
    keys = {(rng.choice([None, *"abcde"]), rng.randrange(400)) for _ in range(3000)}
    df = spark.createDataFrame(list(keys), "a string, b int").repartition(7)
    got = {(r.a, r.b): r.id for r in ranking.dense_ids(df, ["a", "b"], "id").collect()}
    order = sorted(keys, key=lambda k: (k[0] is not None, k[0] or "", k[1]))
    assert got == {k: i for i, k in enumerate(order, 1)}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_loop(spark, descending):
    rng = random.Random(2)
    rows = [(g, v, rng.randrange(5)) for g in "xy" for v in rng.sample(range(10000), 1500)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    got = {
        (r.g, r.v): (r.cum_n, r.all_n)
        for r in ranking.running_totals(df, "v", ["n"], descending, within=["g"]).collect()
    }
    for g in "xy":
        part = sorted([r for r in rows if r[0] == g], key=lambda r: r[1], reverse=descending)
        total, overall = 0, sum(r[2] for r in part)
        for _, v, n in part:
            total += n
            assert got[g, v] == (total, overall)


def test_quantiles_equal_positions_in_the_sorted_list(spark):
    rng = random.Random(3)
    # One value holds more than a third of all rows.
    values = [7.5] * 900 + [round(rng.gauss(0, 50), 2) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    ordered, n = sorted(values), len(values)
    ranked = ranking.ranked_values(df, ["x"])
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    expected = [ordered[max(-(-int(n * p * 1000) // 1000) - 1, 0)] for p in probabilities]
    assert list(ranking.quantiles_of(ranked, probabilities).first())[2:] == expected
    rows = {r.point: r.value for r in ranking.quantile_rows(ranked, probabilities).collect()}
    assert [rows[i] for i in range(len(probabilities))] == expected
    median = ranking.quantiles_of(ranked, [0.5], interpolate=True).first().q_0
    assert median == pytest.approx((ordered[n // 2 - 1] + ordered[n // 2]) / 2)


def test_sketched_quantiles_stay_within_their_rank_error(spark):
    df = spark.range(10000).select(F.col("id").cast("double").alias("x"))
    row = ranking.quantiles(df, ["x"], error=0.01).first()
    for p, value in zip((0.25, 0.5, 0.75), (row.q_0, row.q_1, row.q_2)):
        assert abs(value - p * 10000) <= 100


def test_exact_and_sketched_fences_agree_on_few_values(spark):
    df = spark.createDataFrame([(float(v % 10),) for v in range(500)] + [(99.0,)] * 3, "x double")
    exact = profile.outlier_fences(df, ["x"]).first().asDict()
    assert exact == profile.outlier_fences(df, ["x"], error=0.0001).first().asDict()
    assert exact["n_outliers"] == 3


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    # Key 1 holds most rows; some rows have no key.
    fact = spark.range(3000).select("id", F.expr("CASE WHEN id % 3 > 0 THEN 1 WHEN id % 2 = 0 THEN NULL ELSE id % 50 END AS k"))
    side = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40)], "k long, name string")
    both = [sorted(map(repr, joins.join_dimension(fact, side, "k", how, fits=f).collect())) for f in (True, False)]
    assert both[0] == both[1]


def test_rows_that_are_nothing_but_a_hot_key_are_spread(spark):
    fact = spark.createDataFrame([(1,)] * 5000 + [(None,)] * 500 + [(k,) for k in range(100)], "k long").repartition(4)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(32)).cast("int")
    found = joins.salted(fact, ["k"], spread, F.lit(0), joins.hot_keys(fact, ["k"]))
    salts = {r.k: r.salts for r in found.groupBy("k").agg(F.countDistinct("_salt").alias("salts")).collect()}
    assert salts[1] == 32 and salts[None] > 8 and salts[50] == 1


def test_shuffled_join_takes_any_column(spark):
    fact = spark.createDataFrame([(1, {"a": 1}), (2, {})], "k long, m map<string,int>")
    side = spark.createDataFrame([(1, "x")], "k long, name string")
    assert {(r.k, r.name) for r in joins.join_dimension(fact, side, "k", fits=False).collect()} == {(1, "x"), (2, None)}


def test_broadcasts_share_one_budget(spark):
    small, large = spark.range(10), spark.range(1000)
    assert joins.affordable(large, small, rows=1005) == [False, True]
    assert joins.affordable(large, small, rows=1010) == [True, True]


def test_broadcast_needs_a_measured_size(spark):
    side = spark.range(1000)
    assert joins.fits_broadcast(side, rows=1000)
    assert not joins.fits_broadcast(side, rows=999)
    assert not joins.fits_broadcast(side, size=1000)


def test_first_per_key_and_required_values(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, None, 1), (1, "a", 1)], "k int, x string, y int")
    first = quality.first_per_key(df, ["k"], ["x", "y"])
    assert sorted(map(tuple, first.collect())) == [(1, "a", 1), (2, None, 1)]
    assert sorted(map(tuple, quality.first_per_key(first, ["k"], ["x", "y"]).collect())) == sorted(map(tuple, first.collect()))
    kept, rejected = quality.split_required(first, ["k", "x"])
    assert [r.k for r in kept.collect()] == [1] and [r.k for r in rejected.collect()] == [2]


def test_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 30)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (None,), (30,)], "pk int")
    assert [r.id for r in quality.orphans(fact, parent, "fk", "pk").collect()] == [2]
    assert [tuple(r) for r in quality.orphan_counts(fact, {"fk": (parent, "pk")}).collect()] == [("fk", 1)]


def test_orphans_are_counted_by_value_not_by_text(spark):
    fact = spark.createDataFrame([(1.0, None, -0.0), (2.0, None, 0.0), (3.0, None, 7.0)], "a double, b int, c double")
    parent = spark.createDataFrame([(1, 0.0), (2, 5.0)], "pk bigint, pc double")
    amounts = fact.withColumn("d", F.col("a").cast("decimal(10,4)"))
    cents = parent.withColumn("pd", F.col("pk").cast("decimal(6,2)"))
    parents = {"a": (parent, "pk"), "b": (parent, "pk"), "c": (parent, "pc"), "d": (cents, "pd")}
    got = {r.foreign_key: r.n_orphans for r in quality.orphan_counts(amounts, parents).collect()}
    assert got == {"a": 1, "b": 0, "c": 1, "d": 1}


def test_planted_orphans(spark):
    fact = spark.range(100).select("id", (F.col("id") % 10).alias("k"))
    parent = spark.range(7).withColumnRenamed("id", "pk")
    assert quality.orphan_counts(fact, {"k": (parent, "pk")}).first().n_orphans == 30
    assert quality.orphans(fact, parent, "k", "pk").count() == 30


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(20000).withColumnRenamed("id", "busbreakdown_id")
    shuffled = df.orderBy(F.rand(5)).repartition(13)
    sides = [{r[0] for r in split.hash_split(d)[0].collect()} for d in (df, shuffled)]
    assert sides[0] == sides[1] and 0.78 < len(sides[0]) / 20000 < 0.82
    train, test = split.hash_split(df)
    assert train.count() + test.count() == 20000
    sizes = [r["count"] for r in split.with_folds(df, 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 6000
    text = df.select(F.col("busbreakdown_id").cast("string").alias("t"))
    assert 0.13 < split.hash_sample(text, 0.15, ["t"]).count() / 20000 < 0.17


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(v % 17),) for v in range(1000)] + [(None,)], "x double")
    rows = distributions.histogram(df, "x", 8).collect()
    assert sum(r.n for r in rows) == 1000
    assert rows[0].low_edge == 0.0 and rows[-1].high_edge == 16.0
    constant = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [r.n for r in distributions.histogram(constant, "x", 8).collect()] == [4]


def test_histogram_has_every_bin_and_leaves_out_what_is_outside(spark):
    df = spark.createDataFrame([(float(v),) for v in range(-10, 31)] + [(float("nan"),)], "x double")
    rows = distributions.histogram(df, "x", 4, low=0, high=20).collect()
    assert [(r.bin, r.n) for r in rows] == [(1, 5), (2, 5), (3, 5), (4, 6)]
    ends = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    assert [r.n for r in distributions.histogram(ends, "x", 5).collect()] == [1, 0, 0, 0, 1]
    assert distributions.histogram(ends.limit(0), "x", 5).count() == 0


def test_density_far_from_zero_and_without_spread(spark):
    rng = random.Random(6)
    values = [rng.gauss(0, 1) for _ in range(500)]
    near, far = (
        distributions.density(spark.createDataFrame([(v + shift,) for v in values], "x double"), "x").collect() for shift in (0, 1e9)
    )
    assert max(r.density for r in far) == pytest.approx(max(r.density for r in near), rel=1e-3)
    for rows in ([(3.0,)] * 5, [(3.0,)]):
        found = distributions.density(spark.createDataFrame(rows, "x double"), "x", points=5).collect()
        assert [(r.x, r.density) for r in found] == [(3.0, None)] * 5


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "x double")
    row = profile.outlier_fences(df, ["x"]).first()
    assert (row.q3, row.n_outliers) == (2.0, 0)


def test_density_integrates_to_about_one(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(2000)], "x double")
    rows = distributions.density(df, "x", points=200).collect()
    step = rows[1].x - rows[0].x
    assert sum(r.density for r in rows) * step == pytest.approx(1, abs=0.02)


def test_correlation_of_a_constant_column_is_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (None, 5.0, 0.0)], "a double, b double, c double")
    r = {(x.row_name, x.column_name): x.r for x in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert r["a", "c"] == pytest.approx(1.0) and r["a", "a"] == 1.0
    assert r["a", "b"] is None and r["b", "b"] is None and len(r) == 9
