"""Quality rules: counts of the whole text, and a calibrated classifier over hashed n-grams.

The classifier is a logistic regression over hashed single words, word pairs and character 4-grams (code points, whatever
their length in bytes), as shares of the text's n-grams. It is fitted on labelled rows (column quality) whose ``crc32(doc_id) mod 4`` is 0 or 1, and calibrated
(Platt's sigmoid) on those where it is 3; the quarter where it is 2 stays unseen. At most ``most_rows`` labelled rows
(those with the smallest hash of the id; of rows that repeat an id one) are used; their n-gram counts come to the driver, some 10 kB a row. Texts are
scored whole, in Arrow batches, a few MB at a time, against a fixed threshold; the weights are a broadcast of
``4 * 2 ** BITS`` bytes. There is no shuffle of texts.

Defined results: null and empty texts have no words and fail the base rules, as do all of fewer than 20 words; repeated
rows get equal verdicts; an empty table gives an empty result; without labels of both kinds the probability is 1 and
the base rules alone decide; labels that are null are not used, and of several labels of a document the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import one_row_per_id, texts
from latewatch.llm.words import BLANK, PLACES, U64, Words, scramble, slices, words
from latewatch.session import durable

BITS = 16
MOST_ROWS = 4_000
THRESHOLD = 0.5
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SCALE = 40.0
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STRIP = b" \t\n\x0b\x0c\r"


def per_text(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of a column between consecutive borders."""
    return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[borders])


def repeat_words(found: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each text inside 8-word windows that the text has twice or more."""
    runs, of, at = found.runs(hashes, WINDOW, short=False)
    keys = scramble(runs + of.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    steps = np.zeros(len(hashes) + WINDOW + 1, dtype=np.int64)
    starts = np.unique(at[twice])
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    covered = np.cumsum(steps)[: len(hashes)] > 0
    return per_text(covered, np.append(found.first, len(hashes)))


def dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    held, out = data.tobytes(), np.zeros(len(offsets) - 1, dtype=np.int64)
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        lines = [line for line in held[a:b].split(b"\n") if line.strip(_STRIP)]
        out[k] = len(lines) - len(set(lines))
    return out


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(found: Words, hashes: np.ndarray) -> list[np.ndarray]:
    """The columns of ``BASE``."""
    data, offsets = found.data, found.offsets
    letters = ((data & 0xC0) != 0x80) & ~BLANK[data]
    return [
        found.counts.astype(np.int64),
        per_text(letters, offsets),
        per_text(SYMBOL[data], offsets),
        dup_lines(data, offsets),
        repeat_words(found, hashes),
    ]


GRAM = (PLACES[8], PLACES[9], PLACES[10], PLACES[11])


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character of UTF-8 begins, and a number of its own for each (its bytes, first one lowest)."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lengths = np.diff(np.append(starts, len(data)))
    points = data[starts].astype(np.uint64)
    for k in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > k)
        points[longer] |= data[starts[longer] + k].astype(np.uint64) << U64(8 * k)
    return starts, points


def ngrams(found: Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of all texts: (feature, text) of words, word pairs and character 4-grams, each 2 ** BITS apart by salt."""
    shift = U64(64 - BITS)
    pairs, pair_of, _ = found.runs(hashes, 2, short=False)
    out = [(scramble(hashes) >> shift, found.text_of), (scramble(pairs + U64(1)) >> shift, pair_of)]
    starts, points = code_points(found.data)
    if len(points) >= 4:
        grams = points[:-3] * GRAM[0] + points[1:-2] * GRAM[1] + points[2:-1] * GRAM[2] + points[3:] * GRAM[3]
        of = np.searchsorted(found.offsets, starts, side="right") - 1
        inside = of[:-3] == of[3:]
        out.append((scramble(grams[inside]) >> shift, of[:-3][inside]))
    return out


def linear(found: Words, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted share of the n-grams of each text, without the intercept."""
    n = len(found.counts)
    total, score = np.zeros(n), np.zeros(n)
    for feature, of in ngrams(found, hashes):
        score += np.bincount(of, weights[feature.astype(np.int64)], n)
        total += np.bincount(of, minlength=n)
    return SCALE * score / np.maximum(total, 1)


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams, and slope and intercept of the calibration."""

    weights: np.ndarray
    slope: float
    intercept: float


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(0)):
            found = words(data, offsets)
            n = last - first
            keys = np.concatenate([of * (1 << BITS) + f.astype(np.int64) for f, of in ngrams(found, found.hashes())])
            keys, counts = np.unique(keys, return_counts=True)
            of, feature = keys >> BITS, (keys & ((1 << BITS) - 1)).astype(np.uint16)
            share = counts / np.maximum(np.bincount(of, counts, n), 1)[of]
            cuts = np.searchsorted(of, np.arange(n + 1))
            part = batch.slice(first, n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([feature[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.array([share[a:b].astype(np.float32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    part.column(1),
                    part.column(2),
                ],
                names=["features", "shares", "quality", "fold"],
            )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_weights(features: np.ndarray, shares: np.ndarray, starts: np.ndarray, y: np.ndarray, rounds: int = 120, penalty: float = 1e-5) -> np.ndarray:
    """Logistic regression by Adam over all rows at once; the intercept is left to the calibration."""
    weights, intercept = np.zeros(1 << BITS), 0.0
    first, second = np.zeros(1 << BITS), np.zeros(1 << BITS)
    row = np.repeat(np.arange(len(y)), np.diff(starts))
    values = SCALE * shares
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    for turn in range(1, rounds + 1):
        score = np.bincount(row, weights[features] * values, len(y)) + intercept
        error = (_sigmoid(score) - y) * balance
        slope = np.bincount(features, values * error[row], 1 << BITS) + penalty * weights
        intercept -= error.sum()
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-5)
    return weights


def fit_sigmoid(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's calibration: slope and intercept, with targets drawn in by the counts of either label."""
    ones, zeros = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, at = np.stack([score, np.ones(len(score))], axis=1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ at)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * at)
        at = at + step
        if np.abs(step).max() < 1e-7:
            break
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model | None:
    """``docs``: doc_id, text; ``labels``: doc_id, quality. None without labels of both kinds to fit and to calibrate on."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold != 2))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .withColumn("fold", fold.cast("int"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    sample = durable(one_row_per_id(docs, chosen))
    rows = sample.mapInArrow(_sparse_rows, "features binary, shares binary, quality int, fold int").collect()
    sides = []
    for folds in ((0, 1), (3,)):
        part = [r for r in rows if r["fold"] in folds]
        y = np.array([float(r["quality"] == 1) for r in part])
        if not len(y) or y.min() == y.max():
            return None
        features = [np.frombuffer(r["features"], np.uint16) for r in part]
        starts = np.cumsum([0, *map(len, features)])
        shares = np.concatenate([np.frombuffer(r["shares"], np.float32) for r in part]).astype(float)
        sides.append((np.concatenate(features).astype(np.int64), shares, starts, y))
    weights = fit_weights(*sides[0])
    features, shares, starts, y = sides[1]
    score = np.bincount(np.repeat(np.arange(len(y)), np.diff(starts)), SCALE * weights[features] * shares, len(y))
    return Model(weights.astype(np.float32), *fit_sigmoid(score, y))


def judge(
    docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id``, the columns of ``BASE``, ``base_failed, probability, kept``."""
    rows = texts(docs, id_column, text_column)
    held = docs.sparkSession.sparkContext.broadcast(None if model is None else (model.weights, model.slope, model.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                found = words(data, offsets)
                hashes = found.hashes()
                base = base_counts(found, hashes)
                p = np.ones(last - first)
                if known is not None:
                    weights, slope, intercept = known
                    p = _sigmoid(slope * linear(found, hashes, weights) + intercept)
                failed = (base[0] < LEAST_WORDS) | (100 * base[4] > MOST_REPEATED * base[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *map(pa.array, base), pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))],
                    names=["doc_id", *BASE, "base_failed", "probability", "kept"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in BASE)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_failed boolean, probability double, kept boolean")
