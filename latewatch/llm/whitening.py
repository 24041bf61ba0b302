"""Embedding whitening by polarisation: covariances from exact variances of dimensions and of sums of two dimensions.

An entry c becomes the integer x = floor(64 c) + 1000000, so that everything up to the covariance matrix is exact. The first
pass sums every dimension. The second centres each x by the integer next to its mean and adds up the squares of every
dimension and of every sum of two dimensions. With Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b) the differences of these
variances are the cross-covariances: integers over n squared, rounded to doubles only at the end. ``eigh`` of the assembled
matrix gives the components. A third pass measures the covariance of what is whitened, and the last one returns it.

Sums are exact at any size: they are held in limbs of 32 bits. Entries so large that squares pass 64 bits take Python's
integers, others numpy's. A task passes on one vector of sums for each 4,096 pairs of dimensions; these are added up in two
rounds, streaming, and only the sums (one for every pair of dimensions) come to the driver.

Defined results: a vector that is null or holds null, NaN, infinity or an entry whose x is beyond 62 bits is left out; so
is a vector of another length than the most frequent one (of equally frequent lengths the smallest), also an empty one; rows
that repeat an id, and null ids, are rows like others; ``deviation`` is null where it is no long; ``whitened`` is null
for components without variance (to double precision), and these take no part in ``identity_error``, which is null if
there is no other; ``explained`` is null without any variance; an empty table gives an empty result; other columns are not
read. Components have their largest entry positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows taken at a time; pairs of dimensions whose sums are one row; rows that sums are gathered in before the last round.
ROWS, SLICE, LANES = 2048, 4096, 64
MASK = np.int64(0xFFFFFFFF)


def vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` of the vectors that can be used."""
    found = rows.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) * STEP < float(1 << 62)))
    return found.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fits)


def integers(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place of the first row, and the x of some rows at a time."""
    for start in range(0, len(column), ROWS):
        part = column.slice(start, ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        yield start, np.floor(part * STEP).astype(np.int64) + OFFSET


# ---------------------------------------------------------------- exact sums


def limbs(values: np.ndarray) -> np.ndarray:
    """Non-negative integers as rows of limbs of 32 bits, lowest first."""
    out = []
    while True:
        out.append((values & int(MASK)).astype(np.int64))
        values = values >> 32
        if not values.any():
            return np.array(out)


def carried(sums: np.ndarray) -> np.ndarray:
    """The same numbers with limbs below 2 to the 32."""
    out, over = [], np.zeros_like(sums[0])
    while len(out) < len(sums) or over.any():
        value = over + sums[len(out)] if len(out) < len(sums) else over
        out.append(value & MASK)
        over = value >> 32
    return np.array(out)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) < len(b):
        a, b = b, a
    out = a.copy()
    out[: len(b)] += b
    return out


def column_sums(values: np.ndarray) -> list[int]:
    """Exact sums of the columns of a matrix of 64-bit integers."""
    high, low = (values >> 32).sum(axis=0), (values & MASK).sum(axis=0)
    return [(int(h) << 32) + int(s) for h, s in zip(high, low)]


def squared_sums(y: np.ndarray) -> np.ndarray:
    """Limbs of the sums of squares of every dimension and of every sum of it with a later one, dimension by dimension."""
    most = int(max(y.max(), -int(y.min())))
    if (2 * most) ** 2 * len(y) >= 1 << 63:
        y = y.astype(object)
    out = []
    for i in range(y.shape[1]):
        z = y[:, i:] + y[:, i : i + 1]
        z[:, 0] = y[:, i]
        out.append((z * z).sum(axis=0) if y.dtype == object else np.einsum("rj,rj->j", z, z))
    return limbs(np.concatenate(out))


# ---------------------------------------------------------------- passes


def dimension_sums(found: DataFrame) -> tuple[int, int, list[int]]:
    """Most frequent length, number of its vectors, and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for width in np.unique(sizes).tolist():
                column = batch.column(1).filter(pa.array(sizes == width))
                held = sums.setdefault(width, [0, [0] * width])
                for _, x in integers(column, width):
                    held[0] += len(x)
                    held[1] = [a + b for a, b in zip(held[1], column_sums(x))]
        for width, (n, totals) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([width] * width, pa.int32()),
                    pa.array(range(width), pa.int32()),
                    pa.array([n] * width, pa.int64()),
                    pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0)),
                ],
                names=["width", "place", "n", "total"],
            )

    parts = found.mapInArrow(run, "width int, place int, n long, total decimal(38,0)")
    sums = parts.groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    first = sums.filter("place = 0").orderBy(F.col("n").desc(), "width").first()
    if first is None:
        return 0, 0, []
    rows = sums.filter(F.col("width") == first.width).orderBy("place").collect()  # one row per dimension
    return first.width, first.n, [int(r.total) for r in rows]


def _merge(key: int, held: dict, sums: np.ndarray) -> None:
    if sums.dtype == np.int64:
        held[key] = carried(added(held[key], sums)) if key in held else sums
    else:
        held[key] = held[key] + sums if key in held else sums


def folded(parts: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Sums over tasks of vectors given as (slice, lane, height, sums): in lanes first, then over all lanes."""

    def run_in(lanes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for number, lane, height, data in zip(*(c.to_pylist() for c in batch.columns)):
                    _merge((number, lane % lanes), held, np.frombuffer(data, kind).reshape(height, -1))
            yield packed(held)

        return run

    schema = "slice int, lane int, height int, sums binary"
    lanes = parts.repartition(LANES, "slice", F.col("lane") % LANES).mapInArrow(run_in(LANES), schema)
    sums = lanes.repartition("slice").mapInArrow(run_in(1), schema).collect()  # one row per slice of pairs of dimensions
    return {r["slice"]: np.frombuffer(bytes(r["sums"]), kind).reshape(r["height"], -1) for r in sums}


def packed(held: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in held], pa.int32()),
            pa.array([k[1] for k in held], pa.int32()),
            pa.array([len(s) for s in held.values()], pa.int32()),
            pa.array([np.ascontiguousarray(s).tobytes() for s in held.values()], pa.binary()),
        ],
        names=["slice", "lane", "height", "sums"],
    )


def squares(found: DataFrame, width: int, middle: list[int]) -> list[int]:
    """Sums of squares of the centred x, for every dimension and sum of two dimensions."""
    centre = np.array(middle, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for _, x in integers(batch.column(1), width):
                part = squared_sums(x - centre)
                sums = part if sums is None else carried(added(sums, part))
        if sums is not None:
            lane = TaskContext.get().partitionId()
            yield packed({(k, lane): sums[:, k * SLICE : (k + 1) * SLICE] for k in range(math.ceil(sums.shape[1] / SLICE))})

    slices = folded(found.mapInArrow(run, "slice int, lane int, height int, sums binary"), "<i8")
    out: list[int] = []
    for k in sorted(slices):
        out += [sum(int(v) << (32 * i) for i, v in enumerate(column)) for column in slices[k].T.tolist()]
    return out


@dataclass
class Whitening:
    """What the fit list determines: number of vectors, integer middles and remainders of the sums, components."""

    width: int
    n: int
    middle: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    explained: list[float | None]
    identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates on all components; NaN for those without variance."""
        centred = (x - self.middle).astype(np.float64) - self.rest / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > 0, centred @ self.components / np.sqrt(self.variances), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared."""
        y = x - self.middle
        most = self.n * int(max(y.max(), -int(y.min()))) + int(np.abs(self.rest).max())
        if most * most * self.width < 1 << 63:
            return (np.square(self.n * y - self.rest).sum(axis=1)).tolist()
        exact = [int(s) for s in np.square(self.n * y.astype(object) - self.rest.astype(object)).sum(axis=1)]
        return [s if s < 1 << 63 else None for s in exact]


def covariance(n: int, width: int, rest: list[int], sums: list[int]) -> list[list[int]]:
    """n squared times the covariances, exactly, from sums of squares of dimensions and of sums of two dimensions."""
    own = [0] * width
    starts = np.concatenate([[0], np.cumsum(np.arange(width, 0, -1))]).tolist()
    for i in range(width):
        own[i] = n * sums[starts[i]] - rest[i] ** 2
    out = [[0] * width for _ in range(width)]
    for i in range(width):
        out[i][i] = own[i]
        for j in range(i + 1, width):
            both = n * sums[starts[i] + j - i] - (rest[i] + rest[j]) ** 2
            out[i][j] = out[j][i] = (both - own[i] - own[j]) // 2
    return out


def fit(found: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of usable vectors (as ``vectors`` returns them), or none if there are none."""
    width, n, totals = dimension_sums(found)
    if not n:
        return None
    found = found.filter(F.size("v") == width)
    middle = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * m for s, m in zip(totals, middle)]
    exact = covariance(n, width, rest, squares(found, width, middle))
    matrix = np.array([[c / n**2 for c in row] for row in exact])
    values, vectors_ = np.linalg.eigh(matrix)
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(vectors_.shape[1])])
    values = np.where(values > max(values[0], 0) * width * np.finfo(float).eps, values, 0.0)
    trace = sum(exact[i][i] for i in range(width)) / n**2
    explained = [float(e) / trace if trace else None for e in values]
    model = Whitening(width, n, np.array(middle, np.int64), np.array(rest, np.int64), vectors_, values, explained)
    model.identity_error = identity_error(found, model)
    return model


def identity_error(found: DataFrame, model: Whitening) -> float | None:
    """Largest difference between the covariance of the whitened vectors, measured over all of them, and the identity."""
    real = np.flatnonzero(model.variances > 0)
    if not len(real):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(real) + 1, len(real)))
        for batch in batches:
            for _, x in integers(batch.column(1), model.width):
                w = model.whitened(x)[:, real]
                sums[:-1] += w.T @ w
                sums[-1] += w.sum(axis=0)
        yield packed({(0, TaskContext.get().partitionId()): sums})

    sums = folded(found.mapInArrow(run, "slice int, lane int, height int, sums binary"), "<f8")[0] / model.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(len(real))).max())


def whiten(found: DataFrame, model: Whitening | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every vector of the model's length."""
    kind = found.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if model is None:
        return found.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        for batch in batches:
            for start, x in integers(batch.column(1), model.width):
                rows = np.repeat(np.arange(len(x)), k)
                found_ = model.whitened(x).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(x)).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), model.n)),
                        pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                        pa.array(found_, mask=np.isnan(found_)),
                        pa.array(model.explained * len(x), pa.float64()),
                        pa.array([model.identity_error] * len(rows), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return found.filter(F.size("v") == model.width).mapInArrow(run, schema)
