"""Exact join of texts by the Jaccard similarity of their word shingles: size-banded tiles, bitmap bounds, sorted arrays.

Sets. A text is the set of its shingles of four words, A-Z lower-cased; texts with equal sets are one node.

Bands. Two sets can only be similar enough if their sizes are, so sizes are cut into bands, and a set belongs to its own
band and, where a smaller partner may be in the band below, to that one too. Two linked sets of a band differ in at most D elements.
The hash space is cut into D + spare parts: then at least ``spare`` parts hold the same elements of both, by counting. A
bucket is a band, a part and the elements that a set has in it; so linked sets meet in a bucket, whatever other sets share
with them. Parts without elements are left out, unless a set has so many (``spare`` or more) that they could be all that it has
in common with another: by the same count, that other set then has as many, and both keep them.

Tiles. ``links`` tests each set against one other a round; sets of buckets that still hold several classes meet in tiles. A
hashed bitmap of each set bounds the overlap from above: every bit of A that B lacks is an element of A that B lacks, so that
|A & B| <= |A| - bits(A and not B). Only pairs whose bound reaches the threshold are intersected, as sorted arrays of 64-bit
shingle hashes. A link between two different sets is found if they are not in one class already: classes are exact.

Work: one pass over the texts for sets, keys and bitmaps, one for the shingles of sets in company; one shuffle of the keys,
about a third of the number of shingles. Nothing that grows with the table comes to the driver.

Defined results: texts with fewer than four words have the whole sequence as one shingle; null counts as empty, and texts
without words are linked with nothing, so that their component is their own id; rows that repeat an id are texts of their own;
the component id is the smallest id of the component, null only if it has no other; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import id_order, texts
from latewatch.llm.links import LIGHT_BYTES, LIGHT_ROWS, classes, distinct, in_company, light, overlap, similar, stored_elements
from latewatch.llm.words import U64, scramble, slices, words
from latewatch.operators.joins import fits_broadcast, join_dimension
from latewatch.session import durable

SHINGLE, PER_CENT = 4, 85
#: Ratio of the ends of a band; spare parts of a band for each element in which two sets may differ.
RATIO, SPARE = 1.6, 0.15
#: Bits of a bitmap: a power of two, the largest size of the band at least, between these.
BITS = (64, 1 << 16)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
PART, VALUE, OTHER = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3)


@dataclass(frozen=True)
class Bands:
    """Smallest size, number of parts and spare parts of each band; ``reach``: the largest partner of a set of the band."""

    low: np.ndarray
    parts: np.ndarray
    spare: np.ndarray
    reach: np.ndarray
    bits: np.ndarray

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """The own band of each size, -1 for sizes too small for a link between different sets."""
        return np.searchsorted(self.low, sizes, side="right") - 1

    def below(self, sizes: np.ndarray) -> np.ndarray:
        """The band below the own one where that may hold a smaller partner, else -1."""
        band = self.of(sizes) - 1
        return np.where((band >= 0) & (sizes <= self.reach[np.maximum(band, 0)]), band, -1)


def bands(per_cent: int = PER_CENT) -> Bands:
    low = math.ceil(per_cent / (100 - per_cent))  # n and n + 1 elements, n shared: the smallest sets that differ and link
    rows = []
    while low < 1 << 40:
        high = max(low + 1, int(low * RATIO))
        reach = (high - 1) * 100 // per_cent
        most = (100 - per_cent) * (high - 1 + reach) // (100 + per_cent)
        spare = 1 + math.ceil(SPARE * most)
        bits = min(max(1 << (high - 1).bit_length(), BITS[0]), BITS[1])
        rows.append((low, most + spare, spare, reach, bits))
        low = high
    return Bands(*(np.array(c, np.int64) for c in zip(*rows)))


# ---------------------------------------------------------------- sets


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle."""
    found = words(LOWER[data], offsets)
    hashes, of, _ = found.runs(found.hashes(), SHINGLE, short=True)
    return hashes, of


def part_keys(elements: np.ndarray, of: np.ndarray, band: np.ndarray, cut: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of each text in a band (none in band -1), and the text of each key."""
    parts = np.where(band >= 0, cut.parts[band], 0)
    base = np.cumsum(parts) - parts
    inside = parts[of] > 0
    elements, of = elements[inside], of[inside]
    at = base[of] + (((scramble(elements ^ PART) >> U64(32)) * parts[of].astype(np.uint64)) >> U64(32)).astype(np.int64)
    sums = np.zeros(int(parts.sum()), np.uint64)
    np.add.at(sums, at, scramble(elements ^ VALUE))
    empty = np.bincount(at, minlength=len(sums)) == 0
    text = np.repeat(np.arange(len(band)), parts)
    number = np.arange(len(sums)) - base[text]
    few = np.bincount(text[empty], minlength=len(band)) < np.where(band >= 0, cut.spare[band], 0)
    keys = scramble(sums + scramble((band[text] << 32 | number).astype(np.uint64)))
    keep = ~(empty & few[text])
    return keys[keep], text[keep]


def bitmaps(elements: np.ndarray, of: np.ndarray, bits: np.ndarray) -> list[bytes]:
    """A bitmap of so many bits for each text."""
    starts = np.concatenate([[0], np.cumsum(bits // 8)])
    out = np.zeros(int(starts[-1]), np.uint8)
    place = (elements & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    np.bitwise_or.at(out, starts[of] + (place >> 3), (1 << (place & 7)).astype(np.uint8))
    return [out[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]


def sets(rows: DataFrame, per_cent: int) -> DataFrame:
    """``text`` of (doc_id, digest, text) becomes ``a, b`` (a digest of its set), ``n_shingles``, ``keys`` and ``sketch``
    (size and bitmap)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = bands(per_cent)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(2)):
                n = last - first
                elements, of = distinct(*shingle_hashes(data, offsets))
                size = np.bincount(of, minlength=n)
                a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(a, of, scramble(elements ^ VALUE))
                np.add.at(b, of, scramble(elements ^ OTHER))
                band = cut.of(size)
                found = [part_keys(elements, of, which, cut) for which in (band, cut.below(size))]
                keys, text = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(text, kind="stable")
                ends = np.searchsorted(text[order], np.arange(n + 1)).astype(np.int32)
                maps = bitmaps(elements, of, np.where(band >= 0, cut.bits[band], BITS[0]))
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.array(size.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order].view(np.int64))),
                        pa.array([int(s).to_bytes(8, "little") + m for s, m in zip(size, maps)], pa.binary()),
                    ],
                    names=["doc_id", "digest", "a", "b", "n_shingles", "keys", "sketch"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "digest", "text").mapInArrow(
        run, f"doc_id {kind}, digest long, a long, b long, n_shingles long, keys array<long>, sketch binary"
    )


# ---------------------------------------------------------------- bounds


def overlap_bounds(sizes: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """For each two sets a number that their overlap does not exceed. Longer bitmaps are folded to the shortest."""
    width = min(map(len, maps))
    folded = np.array([np.bitwise_or.reduce(m.reshape(-1, width), axis=0) for m in maps])
    both = np.zeros((len(maps), len(maps)))
    for low in range(0, width, 1024):
        bits = np.unpackbits(folded[:, low : low + 1024], axis=1).astype(np.float32)
        both += bits @ bits.T
    both = both.astype(np.int64)
    own = both.diagonal()
    from_left = sizes[:, None] - (own[:, None] - both)
    return np.minimum(from_left, from_left.T)


def within_bounds(per_cent: int):
    """Of pairs of sets those whose bitmaps allow a link."""

    def likely(sketches: list[bytes], pairs: np.ndarray) -> np.ndarray:
        sizes = np.array([int.from_bytes(s[:8], "little") for s in sketches])
        bounds = overlap_bounds(sizes, [np.frombuffer(s, np.uint8, offset=8) for s in sketches])
        return pairs & similar(bounds, sizes[:, None] + sizes[None, :], per_cent)

    return likely


def intersected(per_cent: int):
    """Judge of the pairs of a tile: bitmap bounds, then sorted arrays of those that are still in different classes."""

    def judge(arrays: list[np.ndarray], pairs: np.ndarray, apart) -> Iterator[tuple[int, int]]:
        sizes = np.array([len(a) for a in arrays])
        bits = np.full(len(arrays), min(max(1 << (4 * int(sizes.max())).bit_length(), BITS[0]), BITS[1]))
        maps = bitmaps(np.concatenate(arrays), np.repeat(np.arange(len(arrays)), sizes), bits)
        bounds = overlap_bounds(sizes, [np.frombuffer(m, np.uint8) for m in maps])
        for i, j in zip(*(x.tolist() for x in np.nonzero(pairs & similar(bounds, sizes[:, None] + sizes[None, :], per_cent)))):
            if apart(i, j) and similar(overlap(arrays[i], arrays[j]), len(arrays[i]) + len(arrays[j]), per_cent):
                yield i, j

    return judge


# ---------------------------------------------------------------- components


def join_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_cent: int = PER_CENT
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``."""
    rows = texts(docs, id_column, text_column).withColumn("digest", F.xxhash64("text"))
    signed = durable(sets(rows, per_cent).withColumn("node", F.monotonically_increasing_id()))
    nodes = durable(
        signed.filter("n_shingles > 0")
        .groupBy("a", "b")
        .agg(F.min(F.struct(id_order(F.col("doc_id")).alias("order"), "node", "digest")).alias("first"))
        .select("a", "b", "first.node", "first.order", "first.digest")
    )
    one = signed.filter("size(keys) > 0").join(light(nodes.select("node")), "node", "left_semi")
    members = in_company(one.select("node", F.explode("keys").alias("key")))
    facts = durable(one.select("node", F.col("n_shingles").alias("weight"), "sketch"))
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", F.col("order.id").alias("first_id"), "digest")
    labels = classes(
        members,
        facts.select("node", "weight"),
        stored_elements(wanted, rows, shingle_hashes, repeated=False),
        facts.select("node", "sketch"),
        within_bounds(per_cent),
        intersected(per_cent),
        per_cent,
    )
    labelled = nodes.join(labels, "node", "left").select("a", "b", "order", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("order").alias("first"))
    of_set = durable(labelled.join(smallest, "label").select("a", "b", F.col("first.id").alias("component_id")))
    fits = fits_broadcast(of_set, rows=LIGHT_ROWS, size=LIGHT_BYTES)
    with_words = join_dimension(signed.filter("n_shingles > 0").select("doc_id", "n_shingles", "a", "b"), of_set, ["a", "b"], "inner", fits)
    without = signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_words.select("doc_id", "n_shingles", "component_id").unionByName(without)
