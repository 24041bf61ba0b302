"""Toxicity by weak supervision.

Many cheap voters, one for each lexicon stem and pattern, say toxic, clean or nothing about a text. Stems are word
beginnings: a few fixed English ones, and those that a bounded sample of labelled rows shows to go with label 1. A
generative label model takes the true label as hidden: by expectation and maximisation it estimates how often each
voter votes which way under either label, starting from the labelled rows (their label is one more voter); voters that
agree beyond what the label explains (correlation of their votes given the label) share their weight. Its posterior
labels train a logistic regression over stem counts and patterns, and that linear classifier scores the texts.

Only fitting looks at labels, and only at labelled rows whose ``crc32(doc_id) mod 4`` is not 2. The sample has at most
``most_rows`` such rows (those with the smallest hash of the id; of rows that repeat an id one); its vote table, a byte per row and stem, is what
comes to the driver. Scoring reads every text whole, in Arrow batches, without a shuffle; the model is a few kB.

Defined results: null and empty texts are scored as texts without any stem; repeated rows get equal scores; an empty
table gives an empty result; without labelled rows (or without both labels among them) the fixed stems alone decide;
labels that are null are not used, and of several labels of a document the largest counts.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import TaskCache, by_size, one_row_per_id, texts
from latewatch.session import durable

# English insults that hold in any corpus.
FIXED_STEMS = (
    "bastard", "bitch", "clown", "cretin", "disgusti", "dumbass", "filthy", "idiot", "imbecile", "jerk", "loser",
    "moron", "pathetic", "retard", "scum", "shut up", "stupid", "trash", "vermin", "worthles",
)
MOST_ROWS = 12_000
MOST_STEMS = 160
THRESHOLD = 0.3
LENGTHS = (4, 5, 6, 7, 8)
TOTALS = (1, 2, 3, 4, 6, 9)
_WORD = re.compile(r"[^\W\d_]+")
_LOUD = re.compile(r"!{2,}")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


# ---------------------------------------------------------------- counting


_automata = TaskCache()


def _automaton(stems: tuple[str, ...]):
    if (found := _automata.get(stems)) is not None:
        return found
    found = _automata[stems] = ahocorasick.Automaton()
    for k, stem in enumerate(stems):
        found.add_word(stem, (k, len(stem)))
    if stems:
        found.make_automaton()
    return found


def stem_counts(text: str, stems: tuple[str, ...], into: np.ndarray) -> int:
    """Adds the words that begin with each stem to ``into``; returns how many words begin with any."""
    low, seen = text.lower(), -1
    total = 0
    for end, (k, size) in _automaton(stems).iter(low) if stems else ():
        start = end - size + 1
        if start == 0 or not low[start - 1].isalpha():
            into[k] += 1
            if start != seen:
                total, seen = total + 1, start
    return total


PATTERNS = ("shouting", "loud marks", "symbols", "short")
_CAPITALS = bytes(c for c in range(128) if chr(c).isupper())


@cache
def _is_capital() -> np.ndarray:
    return np.fromiter((chr(c).isupper() for c in range(sys.maxunicode + 1)), bool)


def capitals(text: str) -> int:
    """How many characters of the whole text are capitals, as ``str.isupper`` has it."""
    if text.isascii():
        data = text.encode("ascii")
        return len(data) - len(data.translate(None, _CAPITALS))
    total = 0
    for start in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[start : start + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        total += int(np.count_nonzero(_is_capital()[codes]))
    return total


def pattern_flags(text: str) -> tuple[bool, ...]:
    """Signs of style, each a voter of its own: capitals, runs of exclamation marks, symbols inside the text, few words."""
    return (
        capitals(text) > 0.5 * len(text) > 0,
        _LOUD.search(text) is not None,
        text.count("#") + text.count("$") + text.count("%") > 0.02 * len(text) > 0,
        text.count(" ") < 20,
    )


def features(values: list[str], stems: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every stem, up to 255, and of words with any stem, words (by blanks) and pattern flags."""
    counts, rest = np.zeros((len(values), len(stems)), np.int64), np.zeros((len(values), 2 + len(PATTERNS)), np.int64)
    for k, text in enumerate(values):
        rest[k, 0] = stem_counts(text, stems, counts[k])
        rest[k, 1] = text.count(" ") + 1
        rest[k, 2:] = pattern_flags(text)
    return counts, rest


def design(counts: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Columns of the linear classifier."""
    total, n_words = rest[:, :1], rest[:, 1:2]
    return np.hstack(
        [
            np.minimum(counts, 3) / 3.0,
            *[(total >= t).astype(float) for t in TOTALS],
            *[(total * d >= n_words).astype(float) * (total >= 2) for d in (30, 100, 300)],
            rest[:, 2:].astype(float),
        ]
    )


# ---------------------------------------------------------------- fitting


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Stored ``text, toxic`` of at most ``most_rows`` labelled documents outside the held-out quarter."""
    chosen = (
        labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    return durable(one_row_per_id(docs, chosen))


def _count_beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label with each beginning, once and three times, in parts of a bounded number of beginnings."""
    names = ["stem", "p1", "n1", "p3", "n3"]
    counts: dict[str, list[int]] = {}

    def told() -> pa.RecordBatch:
        columns = [pa.array([c[k] for c in counts.values()], pa.int64()) for k in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *columns], names=names)

    for batch in (p for b in batches for p in by_size(b, 0)):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            here: Counter = Counter()
            for word in _WORD.findall(text.lower()):
                for n in LENGTHS:
                    if len(word) >= n:
                        here[word[:n]] += 1
            side = 0 if toxic == 1 else 1
            for stem, n in here.items():
                found = counts.setdefault(stem, [0, 0, 0, 0])
                found[side] += 1
                found[side + 2] += n >= 3
            if len(counts) > 100_000:
                yield told()
                counts = {}
    yield told()


def learned_stems(sample: DataFrame, toxic: int, clean: int, most: int = MOST_STEMS) -> tuple[str, ...]:
    """Word beginnings that go with label 1, by the log-likelihood ratio of their document counts."""
    if not toxic or not clean:
        return ()
    counted = (
        sample.mapInArrow(_count_beginnings, "stem string, p1 long, n1 long, p3 long, n3 long")
        .groupBy("stem")
        .agg(*[F.sum(c).alias(c) for c in ("p1", "n1", "p3", "n3")])
    )

    def evidence(p: Column, n: Column) -> Column:
        """Log-likelihood ratio of the counts, where they speak for label 1."""
        share = (p + n) / (toxic + clean)
        ratio = 2 * (p * F.log(p / (toxic * share)) + F.when(n > 0, n * F.log(n / (clean * share))).otherwise(0.0))
        return F.when((p >= 3) & (p / toxic > 4 * (n / clean)), ratio).otherwise(0.0)

    rows = (
        counted.filter((F.col("p1") > F.col("n1")) | (F.col("p3") > F.col("n3")))
        .withColumn("ratio", F.greatest(evidence(F.col("p1"), F.col("n1")), evidence(F.col("p3"), F.col("n3"))))
        .filter("ratio > 14")
        .orderBy(F.col("ratio").desc(), F.length("stem").desc(), "stem")
        .limit(8 * most)
        .collect()
    )
    kept: list[str] = []
    seen: dict[str, set[tuple[int, int]]] = {}
    for row in rows:  # of beginnings of one word that say the same, the longest stands for all
        figures = (row["p1"], row["n1"])
        if any(figures in seen.get(longer, ()) for longer in kept if longer.startswith(row["stem"])):
            continue
        seen.setdefault(row["stem"], set()).add(figures)
        kept.append(row["stem"])
        if len(kept) == most:
            break
    return tuple(kept)


def cast_votes(counts: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Votes of all voters: 1 toxic, -1 clean, 0 nothing. A stem votes toxic once, and once more from three words on;
    the number of words with any stem votes at each step of ``TOTALS``; patterns vote where they occur."""
    total = rest[:, :1]
    return np.hstack(
        [
            (counts >= 1).astype(np.int8),
            (counts >= 3).astype(np.int8),
            np.hstack([np.where(total >= t, 1, -1 if t in (1, 3) else 0).astype(np.int8) for t in TOTALS]),
            rest[:, 2:].astype(np.int8),
        ]
    )


@dataclass
class LabelModel:
    """Naive Bayes over votes with a hidden label, in which correlated voters share their weight."""

    prior: float = 0.1
    given: np.ndarray = field(default_factory=lambda: np.zeros((2, 3, 0)))  # label, vote + 1, voter
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, votes: np.ndarray, start: np.ndarray, trust: tuple[float, float], rounds: int = 15) -> "LabelModel":
        """``start``: first guess of the probability of label 1 for every row. The last voter anchors the labels: how
        often it votes toxic on clean and on toxic rows is given by ``trust`` and not estimated."""
        posterior, self.weight = start, np.ones(votes.shape[1])
        for turn in range(rounds):
            self.prior = float(np.clip(posterior.mean(), 0.005, 0.9))
            sides = (1 - posterior, posterior)
            smooth = 1.0
            self.given = np.empty((2, 3, votes.shape[1]))
            for v in (-1, 0, 1):  # one at a time: as numbers they take eight times the room of the votes
                shown = (votes == v).astype(float)
                for k, p in enumerate(sides):
                    self.given[k, v + 1] = (p @ shown + smooth / 3) / (p.sum() + smooth)
                del shown
            self.given[:, :, -1] = [[1 - t - 1e-6, 1e-6, t] for t in trust]
            if turn in (1, 6):
                self.weight = 1 / (1 + self.correlations(votes, posterior).sum(axis=1))
                self.weight[-1] = 1.0
            posterior = self.posterior(votes)
        return self

    @staticmethod
    def correlations(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """Mean absolute correlation of each pair of voters within the labels, zero with itself."""
        total = np.zeros((votes.shape[1], votes.shape[1]))
        for p in (1 - posterior, posterior):
            p = p / max(p.sum(), 1e-9)
            centred = votes - p @ votes
            centred *= np.sqrt(p)[:, None]
            centred /= np.sqrt(np.einsum("ij,ij->j", centred, centred)) + 1e-6
            total += np.abs(centred.T @ centred) / 2
        np.fill_diagonal(total, 0)
        return np.where(total > 0.1, total, 0)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.given[1]) - np.log(self.given[0])
        said = np.log(self.prior / (1 - self.prior)) + sum((votes == v) @ (odds[v + 1] * self.weight) for v in (-1, 0, 1))
        return 1 / (1 + np.exp(-np.clip(said, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 3.0, rounds: int = 40) -> np.ndarray:
    """Weights and, last, the intercept: Newton's method on soft labels, all but the intercept penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """What scoring needs."""

    stems: tuple[str, ...]
    weights: tuple[float, ...]

    def scores(self, values: list[str]) -> np.ndarray:
        linear = np.asarray(self.weights)
        x = design(*features(values, self.stems))
        return 1 / (1 + np.exp(-np.clip(x @ linear[:-1] + linear[-1], -30, 30)))


def _default(stems: tuple[str, ...]) -> Model:
    weights = np.zeros(len(stems) + len(TOTALS) + 3 + len(PATTERNS) + 1)
    weights[len(stems)], weights[-1] = 4.0, -3.0
    return Model(stems, tuple(weights))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Learns stems, label model and classifier. ``docs``: doc_id, text; ``labels``: doc_id, toxic."""
    sample = labelled_sample(docs, labels, most_rows)
    sides = {int(r["toxic"] == 1): r["n"] for r in sample.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    learned = learned_stems(sample, sides.get(1, 0), sides.get(0, 0))
    stems = tuple(dict.fromkeys([*learned, *(s for s in FIXED_STEMS if s not in learned)]))
    if not sides.get(1) or not sides.get(0):
        return _default(FIXED_STEMS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in by_size(b, 0)):
            counts, rest = features(batch.column(0).to_pylist(), stems)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c.tobytes() for c in np.minimum(counts, 255).astype(np.uint8)], pa.binary()),
                    pa.array([r.tobytes() for r in rest], pa.binary()),
                    batch.column(1).cast(pa.int64()),
                ],
                names=["counts", "rest", "toxic"],
            )

    rows = sample.mapInArrow(counted, "counts binary, rest binary, toxic long").collect()
    counts = np.array([np.frombuffer(r["counts"], np.uint8) for r in rows]).astype(np.int64)
    rest = np.array([np.frombuffer(r["rest"], np.int64) for r in rows])
    known = np.array([r["toxic"] == 1 for r in rows])
    votes = np.hstack([cast_votes(counts, rest), np.where(known, 1, -1).astype(np.int8)[:, None]])
    posterior = LabelModel().fit(votes, np.where(known, 0.95, 0.05), (0.01, 0.9)).posterior(votes)
    return Model(stems, tuple(fit_logistic(design(counts, rest), posterior)))


# ---------------------------------------------------------------- scoring


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    rows = texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in by_size(batch, 1)):
            p = model.scores(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns, judged where they are."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in by_size(batch, place)):
            values = [t or "" for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(model.scores(values) < threshold))

    return docs.mapInArrow(run, docs.schema)
