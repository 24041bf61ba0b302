"""Whitening against exact fractions and numpy over the whole table at once."""

from fractions import Fraction

import numpy as np
import pytest

from conftest import SMALL
from latewatch.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, v string"


def rows_of(spark, found, schema=SCHEMA):
    return spark.createDataFrame([(k, v, 0, "a", "b", "c") for k, v in found], schema).repartition(3)


def run(docs):
    found = whitening.vectors(docs)
    return whitening.whiten(found, whitening.fit(found)).collect()


def test_query_equals_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    x = np.floor(np.array([r["embedding"] for r in table], np.float64) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    got = queries.QUERIES["op12_embedding_whitening"](spark, SMALL).collect()
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(by) == n * 32
    for k in range(32):
        e, u = values[-1 - k], vectors[:, -1 - k]
        w = (x - s / n) @ u / np.sqrt(e)
        mine = np.array([by[r["vec_id"], k + 1]["whitened"] for r in table])
        assert min(np.abs(mine - w).max(), np.abs(mine + w).max()) < 1e-6
        assert abs(by[0, k + 1]["explained"] / (e / values.sum()) - 1) < 1e-9
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    assert [by[r["vec_id"], 1]["deviation"] for r in table] == deviation
    assert {r["n"] for r in got} == {n} and {r["identity_error"] for r in got}.pop() < 1e-9


def test_covariances_are_exact(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(700, 5)) * [1, 1e3, 1e-2, 1e6, 1e9]).astype(np.float32)
    found = whitening.vectors(rows_of(spark, [(k, r.tolist()) for k, r in enumerate(v)]))
    width, n, sums = whitening.dimension_sums(found)
    x = [[int(np.floor(float(c) * 64)) + 1_000_000 for c in r] for r in v]
    assert (width, n, sums) == (5, 700, [sum(c) for c in zip(*x)])
    middle = [(2 * s + n) // (2 * n) for s in sums]
    exact = whitening.covariance(n, 5, [s - n * m for s, m in zip(sums, middle)], whitening.squares(found, 5, middle))
    for i in range(5):
        for j in range(5):
            cov = sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in x)
            assert Fraction(exact[i][j], n) == cov


@pytest.mark.parametrize("size", [1.0, 1e3, 1e9, 1e16])
def test_large_entries(spark, size):
    rng = np.random.default_rng(4)
    v = (rng.normal(size=(60, 3)) * size).tolist()
    docs = rows_of(spark, enumerate(v), SCHEMA.replace("float", "double"))
    got = run(docs)
    x = [[int(np.floor(c * 64)) + 1_000_000 for c in r] for r in v]
    s = [sum(c) for c in zip(*x)]
    deviation = {k: sum((60 * a - b) ** 2 for a, b in zip(r, s)) for k, r in enumerate(x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {k: d if d < 1 << 63 else None for k, d in deviation.items()}
    assert len(got) == 180 and got[0]["identity_error"] < 1e-6


def test_limbs_carry():
    big = [2**200 + 7, 5, 2**64 - 1]
    held = whitening.limbs(np.array(big, dtype=object))
    sums = held
    for _ in range(40):
        sums = whitening.carried(whitening.added(sums, held))
    assert [sum(int(v) << (32 * i) for i, v in enumerate(c)) for c in sums.T] == [41 * b for b in big]
    assert (sums < 2**32).all()


def test_tricky_rows(spark):
    nan, inf = float("nan"), float("inf")
    plain = [(1, [0.5, -0.25]), (2, [0.1, 0.9]), (2, [0.1, 0.9]), (None, [3.0, 1.0]), (3, [-1.0, 0.0])]
    odd = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [3e38, 0.0])]
    got = run(rows_of(spark, plain + odd))
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(k), c) for k, _ in plain for c in (1, 2))
    assert {r["n"] for r in got} == {5} and abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1e-9
    same = run(rows_of(spark, [(k, [1.0, 2.0]) for k in range(4)]))
    assert len(same) == 8 and {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in same} == {(None, None, None, 0)}
    line = run(rows_of(spark, [(k, [float(k), 2.0 * k]) for k in range(9)]))
    assert {r["component"] for r in line if r["whitened"] is None} == {2} and line[0]["identity_error"] < 1e-9
    assert run(rows_of(spark, [])) == [] and run(rows_of(spark, odd[:5])) == []
