"""Classes of similar texts from buckets of candidates, by few comparisons and without losing a link.

Given are members of buckets and an exact test of two texts. A class that is dense (a text with thousands of variants) would
make nearly all its pairs candidates. So first, for ``ROUNDS`` rounds (further ones join little more), every text is tested against one other only: a member of
the largest class in one of its buckets; what passes joins classes, by components over at most one link a text. Only
pairs of different classes that share a bucket can still join anything: the members of such a bucket are laid out in blocks, and
a tile of two blocks bounds the similarity of all its pairs by sketches, in numpy. Pairs that pass, in whichever of the many
buckets that two texts share, gather texts in clouds (components of a spanning forest of each tile), and a text belongs to one
cloud only. The members of a cloud are laid out in tiles once more; those with a pair that passes get their elements there, and
the tile tests such pairs exactly, telling only links that join something. No bucket is expanded into rows of pairs, and no
list of links, classes or members comes to the driver.

A text is here the sorted array of its elements: 64-bit numbers of its shingles, where the k-th occurrence of a shingle may
count as an element of its own (then sets compare as multisets do). Elements are stored once, for texts that share a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.graph import components
from latewatch.llm.words import PLACES, scramble, slices
from latewatch.operators.joins import fits_broadcast, join_dimension
from latewatch.session import durable

ROUNDS = 1
BLOCK = 512
#: Bounds of what is copied to every task, ids and hashes: well below those of a dimension, as several are alive at a time.
LIGHT_ROWS, LIGHT_BYTES = 400_000, 16 << 20
#: Elements of a block on average, so that a tile of long texts stays at some hundred MB.
BLOCK_WEIGHT = 1 << 20


def light(side: DataFrame) -> DataFrame:
    """A table of ids, marked for broadcast if its measured size allows it."""
    return F.broadcast(side) if fits_broadcast(side, rows=LIGHT_ROWS, size=LIGHT_BYTES) else side


# ---------------------------------------------------------------- buckets


def in_company(entries: DataFrame) -> DataFrame:
    """Stored ``key, node`` of entries whose key other nodes have as well (and of the first and last in a partition).

    One shuffle, by ranges of key and node, so that a key that very many nodes have fills several partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row, undecided until the next one is known
        as_before = np.ones(1, dtype=bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held else batch
            key = rows.column(0).to_numpy()
            same = key[1:] == key[:-1]
            before = np.concatenate([as_before, same])
            yield rows.slice(0, rows.num_rows - 1).filter(pa.array(before[:-1] | same))
            held, as_before = rows.slice(rows.num_rows - 1), before[-1:]
        if held:
            yield held

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.select("key", "node").repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")
    return durable(ordered.mapInArrow(run, "key long, node long"))


# ---------------------------------------------------------------- elements


def distinct(hashes: np.ndarray, of: np.ndarray, repeated: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Elements of texts, sorted in each text, and the text of each. ``repeated``: every occurrence is an element."""
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])]) if len(hashes) else np.zeros(0, bool)
    if not repeated:
        return hashes[fresh], of[fresh]
    starts = np.flatnonzero(fresh)
    occurrence = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    elements = scramble(hashes + occurrence.astype(np.uint64) * PLACES[0])
    return elements[np.lexsort((elements, of))], of


def stored_elements(wanted: DataFrame, rows: DataFrame, hashes: Callable, repeated: bool) -> DataFrame:
    """``node, elements`` of the nodes wanted (node, first_id, digest): one row of (doc_id, digest, text) each.

    The texts are read where they are and not shuffled while the list of wanted nodes is small enough to copy. Rows that
    repeat both id and text: a task passes on one, and of several tasks the first counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            fresh = []
            for node in nodes:
                fresh.append(node not in seen)
                seen.add(node)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            for first, last, data, offsets in slices(batch.column(1)):
                found, of = distinct(*hashes(data, offsets), repeated)
                ends = np.searchsorted(of, np.arange(last - first + 1)).astype(np.int32)
                part = np.full(last - first, TaskContext.get().partitionId(), np.int32)
                elements = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(part), elements], names=["node", "part", "elements"]
                )

    side = light(durable(wanted.select("node", "first_id", F.xxhash64("digest").alias("wanted"))))
    found = rows.join(side, (F.xxhash64("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    held = durable(found.select("node", "text").mapInArrow(run, "node long, part int, elements array<long>"))
    parts = held.groupBy("node").agg(F.min("part").alias("first"), F.collect_set("part").alias("parts")).filter(F.size("parts") > 1)
    again = parts.select("node", F.explode("parts").alias("part"), "first").filter("part <> first").drop("first")
    return held.join(light(durable(again)), ["node", "part"], "left_anti").drop("part")


# ---------------------------------------------------------------- single pairs


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Number of common elements of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def similar(shared, total, per_cent: int):
    """Whether 100 times the intersection is at least ``per_cent`` times the union, of sets of ``total`` elements together."""
    return 100 * shared >= per_cent * (total - shared)


def one_pair_each(open_: DataFrame, turn: int) -> DataFrame:
    """Stored ``a, b, label_a, label_b``: each member of a smaller class of a bucket (a), with one member of the largest
    class of one of its buckets (b)."""
    by_label = open_.groupBy("key", "label").agg(
        F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "weight")).alias("leader")
    )
    main = by_label.groupBy("key").agg(F.max(F.struct("n", F.xxhash64("label", F.lit(turn)).alias("draw"), "label", "leader")).alias("main"))
    choice = F.struct(F.col("main.n").alias("n"), F.xxhash64("key", F.lit(turn)).alias("draw"), F.col("main.leader.node").alias("b"),
                      F.col("main.label").alias("label_b"), F.col("main.leader.weight").alias("weight"))
    return durable(
        open_.join(main, "key")
        .filter(F.col("label") != F.col("main.label"))
        .groupBy(F.col("node").alias("a"), F.col("label").alias("label_a"))
        .agg(F.max(choice).alias("c"))
        .select("a", "label_a", "c.b", "c.label_b", "c.weight")
    )


def verified(pairs: DataFrame, elements: DataFrame, per_cent: int) -> DataFrame:
    """Stored ``label_a, label_b`` of the pairs that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                values, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy() - column.offsets[0].as_py()
                sides.append(np.split(values, ends[1:-1]))
            linked = pa.array([similar(overlap(x, y), len(x) + len(y), per_cent) for x, y in zip(*sides)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(linked), batch.column(1).filter(linked)], names=["label_a", "label_b"])

    leaders = pairs.select("b", "weight").distinct()
    volume = leaders.agg(F.coalesce(F.sum(F.col("weight") + 8), F.lit(0)).alias("n")).first().n * 8
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("x")).join(light(pairs.drop("weight")), "a")
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("y")).join(light(leaders.select("b")), "b")
    both = join_dimension(left, right, "b", "inner", fits=volume <= LIGHT_BYTES // 2)
    return durable(both.select("label_a", "label_b", "x", "y").mapInArrow(run, "label_a long, label_b long"))


# ---------------------------------------------------------------- tiles


def tiles(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members of buckets with several classes, with their sketches, gathered in tiles of a bounded number of rows
    and of elements (blocks are dealt by hash, so both bounds hold on average; a longer text is held whole).

    The largest class of a bucket need not be compared with itself: the others' blocks meet each other and the
    blocks of the largest. A tile holds two blocks; ``side`` tells which one a member belongs to (2: the only block).
    """

    def blocks(n: Column, weight: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.least(n, F.ceil(weight / BLOCK_WEIGHT)))

    sizes = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    per = (
        sizes.groupBy("key")
        .agg(
            F.sum("n").alias("all"), F.sum("w").alias("weight"), F.max(F.struct("n", "label", "w")).alias("most"), F.count("*").alias("labels")
        )
        .filter("labels > 1")
        .select("key", F.col("most.label").alias("main"),
                blocks(F.col("all") - F.col("most.n"), F.col("weight") - F.col("most.w")).alias("others"),
                blocks(F.col("most.n"), F.col("most.w")).alias("mains"),
                ((F.col("all") <= BLOCK) & (F.col("weight") <= BLOCK_WEIGHT)).alias("small"))
    )

    def tile(kind: str, i: Column, j: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.alias("side"))

    def counted(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)

    dealt = F.xxhash64("node")
    at = F.pmod(dealt, F.when(F.col("label") == F.col("main"), F.col("mains")).otherwise(F.col("others")))
    zero = F.lit(0).cast("long")
    places = (
        F.when(F.col("small"), F.array(tile("all", zero, zero, F.lit(2))))
        .when(F.col("label") == F.col("main"), F.transform(counted(F.col("others")), lambda i: tile("main", i, at, F.lit(1))))
        .otherwise(
            F.concat(
                F.transform(counted(F.col("mains")), lambda j: tile("main", at, j, F.lit(0))),
                F.transform(
                    counted(F.col("others")),
                    lambda j: tile("others", F.least(at, j), F.greatest(at, j), F.when(at == j, 2).when(at < j, 0).otherwise(1)),
                ),
            )
        )
    )
    return (
        members.join(per, "key")
        .join(sketches, "node")
        .select("key", "node", "label", "sketch", F.explode(places).alias("tile"))
        .groupBy("key", "tile.kind", "tile.i", "tile.j")
        .agg(F.collect_list(F.struct("node", "label", "sketch", F.col("tile.side").alias("side"))).alias("held"))
        .filter(F.size("held") > 1)
    )


def allowed(label: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Pairs of a tile to look at: of different classes and of different blocks, each once."""
    order = np.arange(len(label))
    across = ((side != 1)[:, None] & (side == 1)[None, :]) | ((side == 2)[:, None] & (side == 2)[None, :] & (order[:, None] < order[None, :]))
    return across & (label[:, None] != label[None, :])


def likely_pairs(held: pa.StructScalar, likely: Callable[[list[bytes], np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """Nodes, labels and sides of a tile, and its pairs that ``likely`` (sketches, pairs to look at) does not rule out."""
    node, label, side = (held.values.field(k).to_numpy(zero_copy_only=False) for k in ("node", "label", "side"))
    pairs = allowed(label, side)
    return node, label, side, likely(held.values.field("sketch").to_pylist(), pairs) if pairs.any() else pairs


def forest(node: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Members of each component of the pairs of a tile, with its smallest node."""
    pairs = pairs | pairs.T
    left = pairs.any(axis=1)
    while left.any():
        inside = np.zeros(len(node), dtype=bool)
        fresh = inside.copy()
        fresh[np.flatnonzero(left)[0]] = True
        while fresh.any():
            inside |= fresh
            fresh = pairs[fresh].any(axis=0) & ~inside
        left &= ~inside
        yield node[inside], int(node[inside].min())


def clouds(found: DataFrame, likely: Callable[[list[bytes], np.ndarray], np.ndarray]) -> DataFrame:
    """Stored ``key, node``: texts that chains of likely pairs connect, by the smallest node among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for held in batch.column(0):
                node, _, _, pairs = likely_pairs(held, likely)
                for members, first in forest(node, pairs):
                    a.append(members[members != first])
                    b.append(np.full(len(members) - 1, first))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    edges = found.select("held").mapInArrow(run, "a long, b long").distinct()
    return components(edges).select(F.col("label").alias("key"), "node")


def promising(found: DataFrame, likely: Callable[[list[bytes], np.ndarray], np.ndarray]) -> DataFrame:
    """``tile, node, label, side`` of members with a likely pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tile, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                node, label, side, pairs = likely_pairs(held, likely)
                out += [(tile, int(node[k]), int(label[k]), int(side[k])) for k in np.flatnonzero(pairs.any(axis=0) | pairs.any(axis=1))]
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["tile", "node", "label", "side"])

    named = found.select(F.xxhash64("key", "kind", "i", "j").alias("tile"), "held")
    return named.mapInArrow(run, "tile long, node long, label long, side int")


def joining_links(open_: DataFrame, elements: DataFrame, judge: Callable) -> DataFrame:
    """``label_a, label_b``: for each tile as few links between classes as join the same classes.

    ``judge`` (arrays of elements, pairs to look at, whether two members are still in different classes) tells linked pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in batch.column(0):
                found = row.values
                label, side = (found.field(k).to_numpy(zero_copy_only=False) for k in ("label", "side"))
                column = found.field("elements")
                ends = column.offsets.to_numpy() - column.offsets[0].as_py()
                arrays = np.split(column.flatten().to_numpy().view(np.uint64), ends[1:-1])
                parent = {k: k for k in label.tolist()}

                def top(k: int) -> int:
                    while parent[k] != k:
                        parent[k] = k = parent[parent[k]]
                    return k

                def apart(i: int, j: int) -> bool:
                    return top(int(label[i])) != top(int(label[j]))

                for i, j in judge(arrays, allowed(label, side), apart):
                    x, y = top(int(label[i])), top(int(label[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        out.append((x, y))
            columns = list(zip(*out)) if out else [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["label_a", "label_b"])

    return (
        open_.join(elements, "node")
        .groupBy("tile")
        .agg(F.collect_list(F.struct("node", "label", "side", "elements")).alias("held"))
        .select("held")
        .mapInArrow(run, "label_a long, label_b long")
    )


# ---------------------------------------------------------------- classes


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Stored ``node, weight, label`` after links between labels."""
    merged = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct())
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("lower"))
    return durable(labels.join(merged, "label", "left").select("node", "weight", F.coalesce("lower", "label").alias("label")))


def mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored ``key, node, weight, label`` of the members of buckets with more than one class."""
    placed = members.select("key", "node").join(labels, "node")
    several = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    return durable(placed.join(several, "key"))


def once(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one, and of all buckets that have the same members only of one: two similar texts
    share many buckets, often alone."""
    names = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"set_{k}") for k in (1, 2)]
    held = members.groupBy("key").agg(F.count("*").alias("n"), *names).filter("n > 1")
    kept = held.groupBy("n", "set_1", "set_2").agg(F.min("key").alias("key")).select("key")
    return members.join(kept, "key")


def classes(
    members: DataFrame, weights: DataFrame, elements: DataFrame, sketches: DataFrame, likely: Callable, judge: Callable, per_cent: int
) -> DataFrame:
    """``node, weight, label`` for all nodes of ``weights`` (node, weight); members and sketches are (key, node) and (node, sketch).

    The label is the smallest node of the class.
    """
    labels = durable(weights.withColumn("label", F.col("node")))
    open_ = mixed(once(members), labels)
    for turn in range(ROUNDS):
        links = verified(one_pair_each(open_, turn), elements, per_cent)
        if links.isEmpty():
            break
        labels = relabelled(labels, links)
        open_ = mixed(open_, labels)
    open_ = mixed(clouds(tiles(open_, sketches), likely), labels)
    found = durable(promising(tiles(open_, sketches), likely))
    links = durable(joining_links(found, elements, judge))
    return labels if links.isEmpty() else relabelled(labels, links)
