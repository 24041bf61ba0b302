"""Near duplicates by BagMinHash: weighted minhash of word-shingle multisets, bands, exact verification.

Signature. Of every shingle a Poisson process runs over time and weight: a point falls on a random register at a random
weight level, and a text that has the shingle w times sees the points at levels up to w. A register keeps its earliest
point; two texts keep the same one with a probability equal to their weighted Jaccard similarity (shared shingles over
all shingles, with repetition). The weight axis is cut hierarchically into the levels (0,1], (1,2], (2,4], (4,8] and so
on: a part that lies below w is drawn as one process, in the part that w cuts the level of each point decides. Points come in
ascending order and a text stops once its time limit, set so that its registers are filled, is passed.

Candidates. ``BANDS`` bands of ``ROWS`` registers; texts meet in a bucket if they agree on a band. At a similarity of
0.8 a pair meets nowhere with a probability below 0.00005.

Classes. Exact copies are one node. ``links`` compares each text with one other a round, exactly, then members of buckets
that still hold several classes in tiles: by their sketches (a byte of each register) first, and pairs that the sketch puts within
five standard errors of the threshold by their shared shingles, of all pairs of a tile as one matrix product. Of the links that
the bands show between different classes, the sketch loses one at a similarity of 0.8 with a probability below 0.000002 (fewer
than 78 of 125 registers agree), and fewer above it.

Work: one pass over the texts for the signatures, one for the shingles of candidates; everything else moves ids, sketches and
the shingles of pairs. No list of links, classes or fingerprints comes to the driver.

Defined results: shingles are five words (a text of fewer words is one shingle); texts without words have no
shingles: they are copies of each other if equal, else alone; null counts as empty; rows that repeat an id are judged
one by one; the class id is the smallest id of the class, null only if it has no other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.exact_dedup import text_digest
from latewatch.llm.inputs import id_order, texts
from latewatch.llm.links import LIGHT_BYTES, LIGHT_ROWS, classes, in_company, light, similar, stored_elements
from latewatch.llm.words import PLACES, U64, scramble, slices, words
from latewatch.operators.joins import fits_broadcast, join_dimension
from latewatch.session import durable

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
#: Columns of the matrix of a tile that are counted at a time.
COLUMNS = 1 << 15


# ---------------------------------------------------------------- signatures


def multisets(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, element and count of the distinct elements of each text (elements cut to 44 bits)."""
    keys = np.sort((of.astype(np.uint64) << U64(44)) | (hashes >> U64(20)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> U64(44)).astype(np.int64), keys & U64((1 << 44) - 1), counts


def _draw(of: np.ndarray, seeds: np.ndarray, low: np.ndarray, weight: np.ndarray, limit: np.ndarray, registers: np.ndarray, m: int) -> None:
    """All points up to the time limits of the texts go into ``registers``: time in the upper half, name in the lower.

    A process covers the levels from ``low`` (to twice that, or 0 to 1) as far as ``weight``.
    """
    size = np.maximum(low, 1)
    pace = 1.0 / (size * m)
    time, state, until = np.zeros(len(of)), seeds.copy(), limit[of]
    while len(of):
        state = state + U64(0x9E3779B97F4A7C15)
        drawn = scramble(state)
        time = time - np.log(((drawn >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) * pace
        go = time <= until
        if not go.all():
            of, time, state, until, low, weight, size, pace = (x[go] for x in (of, time, state, until, low, weight, size, pace))
        if not len(of):
            break
        name = scramble(state ^ U64(0xD1B54A32D192ED03))
        place = of * m + (((name >> U64(32)) * U64(m)) >> U64(32)).astype(np.int64)
        entry = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << U64(32)) | (name & U64(0xFFFFFFFF))
        if low.any():
            level = low + 1 + ((((name * U64(0x9E3779B97F4A7C15)) >> U64(32)) * size.astype(np.uint64)) >> U64(32)).astype(np.int64)
            seen = (low == 0) | (level <= weight)
            place, entry = place[seen], entry[seen]
        np.minimum.at(registers, place, entry)


def signatures(hashes: np.ndarray, of: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the points that the m registers of n texts keep (0 where a text has no shingle), and texts' weights."""
    of, elements, counts = multisets(hashes, of)
    total = np.bincount(of, counts, n)
    parts, low = [], 0
    while (sel := np.flatnonzero(counts > low)).size:
        parts.append((of[sel], scramble(elements[sel] * U64(64) + U64(low.bit_length())), np.full(len(sel), low), counts[sel]))
        low = max(1, 2 * low)
    registers = np.full(n * m, np.iinfo(np.uint64).max, dtype=np.uint64)
    if parts:
        items = [np.concatenate(c) for c in zip(*parts)]
        limit = np.where(total > 0, (math.log(m) + 3) / np.maximum(total, 1), 0.0)
        while True:
            _draw(*items, limit, registers, m)
            open_ = (registers.reshape(n, m) == np.iinfo(np.uint64).max).any(axis=1) & (total > 0)
            if not open_.any():
                break
            limit = np.where(open_, limit * 2, 0.0)  # the few texts left: the same points again, and on
            keep = open_[items[0]]
            items = [c[keep] for c in items]
    names = (registers & U64(0xFFFFFFFF)).reshape(n, m)
    names[total == 0] = 0
    return names, total.astype(np.int64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle, repeated ones too."""
    found = words(data, offsets)
    hashes, of, _ = found.runs(found.hashes(), SHINGLE, short=True)
    return hashes, of


def sign(rows: DataFrame) -> DataFrame:
    """``text`` of (doc_id, digest, text) becomes ``weight`` (number of shingles), ``bands`` and ``sketch``."""
    m = BANDS * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = scramble(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2)):
                names, total = signatures(*shingle_hashes(data, offsets), last - first, m)
                keys = scramble((names.reshape(-1, BANDS, ROWS) * PLACES[:ROWS]).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                sketch = (scramble(names) & U64(255)).astype(np.uint8)
                ends = np.arange(0, (last - first + 1) * BANDS, BANDS, dtype=np.int32)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(total),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    names=["doc_id", "digest", "weight", "bands", "sketch"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "digest", "text").mapInArrow(
        run, f"doc_id {kind}, digest string, weight long, bands array<long>, sketch binary"
    )


# ---------------------------------------------------------------- links


def sketch_cut(similarity: float) -> float:
    """Share of agreeing registers from which a pair is worth its texts: five standard errors below the similarity."""
    return similarity - 5 * math.sqrt(similarity * (1 - similarity) / (BANDS * ROWS))


def sketches_agree(cut: float):
    """Of pairs of texts those whose sketches agree on so many registers."""

    def likely(sketches: list[bytes], pairs: np.ndarray) -> np.ndarray:
        sketch = np.array([np.frombuffer(s, np.uint8) for s in sketches])
        out = np.zeros_like(pairs)
        for k in np.flatnonzero(pairs.any(axis=1)):
            others = np.flatnonzero(pairs[k])
            out[k, others] = (sketch[others] == sketch[k]).mean(axis=1) >= cut
        return out

    return likely


def shared_counts(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many elements each two texts share, and how many each has.

    Elements are the columns of a 0/1 matrix, and the matrix times its transpose counts what rows share. Elements of a
    single text are left out, and the others are taken some thousand at a time.
    """
    n = len(arrays)
    sizes = np.array([len(a) for a in arrays])
    of = np.repeat(np.arange(n), sizes)
    elements, number = np.unique(np.concatenate(arrays), return_inverse=True)
    common = np.bincount(number, minlength=len(elements)) > 1
    place = np.cumsum(common) - 1
    keep = common[number]
    number, of = place[number[keep]], of[keep]
    order = np.argsort(number, kind="stable")
    number, of = number[order], of[order]
    shared = np.zeros((n, n))
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(number, [low, low + COLUMNS])
        matrix = np.zeros((n, min(COLUMNS, int(common.sum()) - low)), np.float32)
        matrix[of[a:b], number[a:b] - low] = 1
        shared += matrix @ matrix.T
    return shared, sizes


def counted_links(per_cent: int):
    """Judge of the pairs of a tile: all overlaps as one matrix product."""

    def judge(arrays: list[np.ndarray], pairs: np.ndarray, apart) -> Iterator[tuple[int, int]]:
        shared, sizes = shared_counts(arrays)
        return zip(*np.nonzero(pairs & similar(shared, sizes[:, None] + sizes[None, :], per_cent)))

    return judge


# ---------------------------------------------------------------- classes


def near_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per input row: ``doc_id, class_id, class_size, digest``, with ``first`` true for the digest of the class
    id's row."""
    per_cent = round(100 * similarity)
    rows = texts(docs, id_column, text_column).withColumn("digest", text_digest(F.col("text")))
    signed = durable(sign(rows).withColumn("node", F.monotonically_increasing_id()))
    nodes = durable(
        signed.groupBy("digest")
        .agg(F.min(F.struct(id_order(F.col("doc_id")).alias("order"), "node")).alias("first"), F.count("*").alias("copies"))
        .select("first.node", "digest", "first.order", "copies")
    )
    one = durable(
        signed.filter("weight > 0").select("node", "weight", "bands", "sketch").join(light(nodes.select("node")), "node", "left_semi")
    )
    members = in_company(one.select("node", F.explode("bands").alias("key")))
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", F.col("order.id").alias("first_id"), "digest")
    labels = classes(
        members,
        one.select("node", "weight"),
        stored_elements(wanted, rows, shingle_hashes, repeated=True),
        one.select("node", "sketch"),
        sketches_agree(sketch_cut(similarity)),
        counted_links(per_cent),
        per_cent,
    )
    labelled = nodes.join(labels, "node", "left").select("digest", "order", "copies", F.coalesce("label", "node").alias("label"))
    first = labelled.groupBy("label").agg(F.min(F.struct("order", "digest")).alias("first"), F.sum("copies").alias("class_size"))
    of_digest = durable(
        labelled.join(first, "label").select(
            "digest", F.col("first.order.id").alias("class_id"), "class_size", (F.col("first.digest") == F.col("digest")).alias("first")
        )
    )
    fits = fits_broadcast(of_digest, rows=LIGHT_ROWS, size=LIGHT_BYTES)
    return join_dimension(signed.select("doc_id", "digest"), of_digest, "digest", "inner", fits).select(
        "doc_id", "class_id", "class_size", "digest", "first"
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of the class id, with all its columns."""
    winners = near_classes(docs, id_column, text_column, similarity).filter("first").select(F.col("digest").alias("winner")).distinct()
    text = F.coalesce(F.col(f"held.{text_column}").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("held")).select("held", text_digest(text).alias("digest"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy(F.col(f"held.{id_column}").asc_nulls_last()))
    return (
        held.withColumn("place", place)
        .filter("place = 1")
        .join(winners, F.col("digest") == F.col("winner"), "left_semi")
        .select("held.*")
    )
