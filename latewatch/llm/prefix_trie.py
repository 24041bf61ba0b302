"""The trie of conversation beginnings, from sorted matrices of turn ids.

A turn is named by 16 bytes of the SHA-256 of its role and text, so that texts are read once and never moved. Conversations are
rebuilt (below), dealt out in ranges of (turn ids, conv_id), and stored: equal conversations may fill many shards. A task lays
the turn ids of its shard out as rows, padded, some columns at a time, and sorts them with numpy's ``lexsort``; rows that are
alone with their beginning leave before the next columns. Neighbouring rows are compared column by column: the change masks,
OR-accumulated along a row, tell from which depth on a row starts nodes of its own. So a node is a run of rows, and for every depth
that rows share ``reduceat`` adds up each run.

All figures are sums over a node's rows. With s the depth to which a row agrees with the row before: the row starts a child of the
node at depth d if s <= d < its length; it is the end of a leaf if the next row does not go on from it; and it saves the
words of its turns up to s, but for those above the node, unless the node starts with it. So a task has to know no more than how far
its first and last row agree with the rows of the neighbouring shards. Nodes that go on there ("open") leave the
task as parts and are added up by path. Members that end in an open node leave as strings of up to ``CHUNK`` ids, which are
hashed one after another, streaming.

Rebuilt: the first h turns of conversation c - c % 20 come before c's own turns after its first h, h = crc32(c) % 4.

Bounds: the turn ids of one shard (16 bytes a turn) in one task, and so those of one conversation; texts and members of a node
are nowhere gathered. The table of shard borders has one row a shard.

Defined results: rows without a conv_id belong to no conversation and are left out; turns with the same number come in the
order of role, then of the digest of role and text (a row that repeats another is a turn like others); null role or text is
empty; c % 20 has the sign of c; a conversation that has no turn when rebuilt ends in the root; a text of any length counts as
a whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import os.path
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.inputs import SPACE, WORD, word_count
from latewatch.operators.joins import join_dimension
from latewatch.session import durable

GROUP, HEADS = 20, 4
NAME = 16
#: Columns of the matrix at a time; turns of a shard on average, at most; ids in one string; rows of an output batch.
WIDTH, TURNS, CHUNK, BATCH = 16, 250_000, 50_000, 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- conversations


def turn_name(role: Column, text: Column) -> Column:
    """16 bytes in hex for a role and a text."""
    sized = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(sized.cast("binary"), 256), 1, 2 * NAME)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (the names of its turns, one after another) and ``words`` (of each turn)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn").alias("turn"),
            role.alias("role"),
            turn_name(role, text).alias("name"),
            word_count(text).alias("words"),
        ).alias("t"),
    ).filter("conv_id IS NOT NULL")
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words"))).alias("own")
    )
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, HEADS - 1).alias("head")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    head = F.coalesce("head", F.slice("own", 1, 0))
    turns_ = F.concat(F.slice(head, F.lit(1), h.cast("int")), F.slice("own", h.cast("int") + 1, F.size("own")))
    return (
        own.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
        .select("conv_id", turns_.alias("t"))
        .select(
            "conv_id",
            F.unhex(F.array_join(F.transform("t", lambda t: t["name"]), "")).alias("path"),
            F.transform("t", lambda t: t["words"]).alias("words"),
        )
    )


def sharded(paths: DataFrame, shards: int) -> DataFrame:
    """Stored conversations in ranges of path and conv_id, with ``left`` and ``right``: how many turns the first row of
    the shard shares with the row before it, and the last row with the row after it (-1 where there is none)."""
    held = durable(paths.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id()))
    order = Window.orderBy("shard")
    borders = held.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    beside = borders.select(
        "shard", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shared(a: bytes | None, b: bytes | None) -> int:
            return -1 if a is None or b is None else len(os.path.commonprefix([a, b])) // NAME

        for batch in batches:
            _, first, last, before, after = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(shared, before, first), pa.int32()), pa.array(map(shared, last, after), pa.int32())],
                names=["shard", "left", "right"],
            )

    return held.join(F.broadcast(beside.mapInArrow(run, "shard int, left int, right int")), "shard")


# ---------------------------------------------------------------- one shard


class Shard:
    """Conversations of one shard as numbers: ``names`` are ranks of turn names, in their order, from 1."""

    def __init__(self, conv: np.ndarray, data: bytes, words: np.ndarray, first: np.ndarray, left: int, right: int):
        halves = np.frombuffer(data, ">u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        fresh = np.concatenate([[True], (halves[order[1:]] != halves[order[:-1]]).any(axis=1)]) if len(order) else order
        self.names = np.zeros(len(order), np.int32)
        self.names[order] = np.cumsum(fresh)
        self.total = np.concatenate([[0], np.cumsum(words)])
        self.data, self.left, self.right = data, left, right
        self.conv, self.first, self.length = conv, first[:-1], np.diff(first)
        order = self._order()
        self.conv, self.first, self.length = conv[order], self.first[order], self.length[order]
        self.shared = self._shared()  # turns that a row shares with the row before
        self.next = np.append(self.shared[1:], right)

    def padded(self, rows: np.ndarray, low: int) -> np.ndarray:
        """Turn ids of the columns from ``low`` on, 0 where a row has ended."""
        places = low + np.arange(WIDTH)
        inside = places < self.length[rows][:, None]
        return np.where(inside, np.append(self.names, 0)[np.where(inside, self.first[rows][:, None] + places, 0)], 0)

    def _order(self) -> np.ndarray:
        """Rows by turn ids, then conv_id. Groups of rows that are equal so far, and go on, are sorted by the next columns."""
        place, rows, low = np.zeros(len(self.conv), np.int64), np.arange(len(self.conv)), 0
        while len(rows):
            matrix = self.padded(rows, low)
            order = np.lexsort((*matrix.T[::-1], place[rows]))
            rows, matrix = rows[order], matrix[order]
            group = np.concatenate([[True], place[rows[1:]] != place[rows[:-1]]])
            part = group | np.concatenate([[True], (matrix[1:] != matrix[:-1]).any(axis=1)])
            at = np.arange(len(rows))
            starts = np.flatnonzero(part)
            place[rows] += np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
            sizes = np.diff(np.append(starts, len(rows)))
            low += WIDTH
            rows = rows[np.repeat((sizes > 1) & (np.maximum.reduceat(self.length[rows], starts) > low), sizes)]
        return np.lexsort((self.conv, place))

    def _shared(self) -> np.ndarray:
        shared = np.zeros(len(self.conv), np.int64)
        shared[0] = self.left
        rows, low = np.arange(1, len(self.conv)), 0
        while len(rows):
            here = self.padded(rows, low)
            changed = np.logical_or.accumulate((here != self.padded(rows - 1, low)) | (here == 0), axis=1)
            shared[rows] += (~changed).sum(axis=1)
            rows = rows[~changed[:, -1]]
            low += WIDTH
        return shared

    def words_to(self, rows: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """Words in the first turns of rows."""
        first = self.first[rows]
        return self.total[first + np.maximum(depth, 0)] - self.total[first]

    def keys(self, row: int, depth: int) -> list[bytes]:
        """A digest of the path of a row for each depth from 0 on."""
        digest, out = hashlib.sha256(), []
        names = self.first[row] * NAME
        for k in range(depth + 1):
            if k:
                digest.update(self.data[names + (k - 1) * NAME : names + k * NAME])
            out.append(digest.copy().digest())
        return out

    def nodes(self) -> Iterator[dict[str, list]]:
        """Columns of complete nodes, of parts of open nodes, and of ids that end in open nodes."""
        rows, last = np.arange(len(self.conv)), len(self.conv) - 1
        deepest = np.maximum(self.shared, self.next)  # the deepest node of a row that is open or has more than one row
        saves = self.words_to(rows, self.shared)
        leaf = (self.next < self.length).astype(np.int64)
        keys = {1: self.keys(0, self.left), 2: self.keys(last, self.right)}
        above = np.full(len(rows), -1)  # of each row's node one depth higher: its first row
        side = np.zeros(len(rows), np.int64)  # and whether it is open: 1 on the path of the first row, 2 on that of the last
        smallest = self.conv.copy()  # and its smallest member
        for depth in range(int(deepest.max()) + 1):
            rows = rows[deepest[rows] >= depth]
            starts = np.flatnonzero((self.shared[rows] < depth) | (rows == 0))
            firsts = rows[starts]
            sizes = np.diff(np.append(starts, len(rows)))
            conv = np.minimum.reduceat(self.conv[rows], starts)
            begins = self.shared[firsts] < depth
            found = {
                "conv_id": conv,
                "depth": np.full(len(firsts), depth),
                "n_convs": sizes,
                "n_children": np.add.reduceat(((self.length[rows] > depth) & (self.shared[rows] <= depth)).astype(np.int64), starts),
                "n_leaves": np.add.reduceat(leaf[rows], starts),
                "saved": np.add.reduceat(saves[rows], starts) - np.where(begins, saves[firsts], 0),
                "above": self.words_to(firsts, depth - 1),
            }
            ends = np.add.reduceat((self.length[rows] == depth).astype(np.int64), starts)
            open_ = np.where((firsts == 0) & (self.left >= depth), 1, np.where((firsts + sizes > last) & (self.right >= depth), 2, 0))
            parent, parent_side = smallest[firsts], side[firsts]
            found["parent_conv_id"] = [None if depth == 0 or s else int(p) for p, s in zip(parent, parent_side)]
            found["parent_key"] = [keys[s][depth - 1] if s else None for s in parent_side.tolist()]
            found["key"] = [keys[s][depth] if s else None for s in open_.tolist()]
            found["kind"] = np.where(open_ > 0, 1, 0)
            closed = np.where(open_ > 0, 0, ends).tolist()
            found["ends"] = [self.digest(f, n) if n else None for f, n in zip(firsts.tolist(), closed)]
            found["saved"] = np.where(open_ > 0, found["saved"], found["saved"] - (sizes - 1) * found["above"])
            yield found
            for k in np.flatnonzero((open_ > 0) & (ends > 0)).tolist():
                yield from self.chunks(found["key"][k], int(firsts[k]), int(ends[k]))
            smallest[rows], side[rows] = np.repeat(conv, sizes), np.repeat(open_, sizes)
        yield from self.tails(deepest, smallest, side, keys)

    def tails(self, deepest: np.ndarray, smallest: np.ndarray, side: np.ndarray, keys: dict[int, list[bytes]]) -> Iterator[dict[str, list]]:
        """Nodes that one row of this shard alone has."""
        many = self.length - deepest
        cuts = np.searchsorted(np.cumsum(many), np.arange(BATCH, int(many.sum()) + BATCH, BATCH)) + 1
        low = 0
        for high in np.unique(np.minimum(cuts, len(many))).tolist():
            row = np.repeat(np.arange(low, high), many[low:high])
            low = high
            if not len(row):
                continue
            first = np.concatenate([[True], row[1:] != row[:-1]])
            at = np.arange(len(row))
            depth = deepest[row] + 1 + at - np.maximum.accumulate(np.where(first, at, 0))
            end = depth == self.length[row]
            parent = np.where(first, smallest[row], self.conv[row]).tolist()
            parent_side = np.where(first, side[row], 0).tolist()
            one = np.ones(len(row), np.int64)
            yield {
                "conv_id": self.conv[row],
                "depth": depth,
                "n_convs": one,
                "n_children": 1 - end,
                "n_leaves": one,
                "saved": 0 * one,
                "above": 0 * one,
                "parent_conv_id": [None if d == 0 or s else p for d, s, p in zip(depth.tolist(), parent_side, parent)],
                "parent_key": [keys[s][d - 1] if s else None for d, s in zip(depth.tolist(), parent_side)],
                "key": [None] * len(row),
                "kind": 0 * one,
                "ends": [self.digest(r, 1) if e else None for r, e in zip(row.tolist(), end.tolist())],
            }

    def ids(self, first: int, n: int) -> str:
        return ",".join(map(str, self.conv[first : first + n].tolist()))

    def digest(self, first: int, n: int) -> str:
        return hashlib.sha256(self.ids(first, n).encode()).hexdigest()

    def chunks(self, key: bytes, first: int, n: int) -> Iterator[dict[str, list]]:
        starts = list(range(first, first + n, CHUNK))
        empty = [None] * len(starts)
        yield {c: empty for c in COLUMNS} | {
            "conv_id": self.conv[starts],
            "key": [key] * len(starts),
            "kind": [2] * len(starts),
            "ends": [self.ids(s, min(CHUNK, first + n - s)) for s in starts],
        }


COLUMNS = {
    "kind": pa.int32(),
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved": pa.int64(),
    "above": pa.int64(),
    "ends": pa.string(),
}
SCHEMA = (
    "kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, above long, ends string"
)


def shard_nodes(shards: DataFrame) -> DataFrame:
    """Of every shard: complete nodes (kind 0), parts of open nodes (1) and ids that end in open nodes (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        left, right = table["left"][0].as_py(), table["right"][0].as_py()
        words, paths = table["words"].combine_chunks(), table["path"].combine_chunks()
        first = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        data = b"".join(paths.to_pylist())
        shard = Shard(table["conv_id"].to_numpy(), data, words.flatten().to_numpy(), first, left, right)
        del table, held, words, paths
        parts: list[dict[str, list]] = []
        rows = 0
        for found in shard.nodes():
            parts.append(found)
            rows += len(found["conv_id"])
            if rows >= BATCH or found["kind"][0] == 2:
                yield joined(parts)
                parts, rows = [], 0
        if parts:
            yield joined(parts)

    return shards.select("conv_id", "path", "words", "left", "right").mapInArrow(run, SCHEMA)


def joined(parts: list[dict[str, list]]) -> pa.RecordBatch:
    columns = [pa.concat_arrays([pa.array(p[name], kind) for p in parts]) for name, kind in COLUMNS.items()]
    return pa.RecordBatch.from_arrays(columns, names=list(COLUMNS))


# ---------------------------------------------------------------- all shards


def end_digests(chunks: DataFrame) -> DataFrame:
    """``key, ends_sha256`` from strings of ids, ordered by their first id and hashed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(key: bytes, digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != key:
                    if digest:
                        yield batch_of(key, digest)
                    key, digest = name, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest:
            yield batch_of(key, digest)

    ordered = chunks.repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(conversations.count() / TURNS))
    found = durable(shard_nodes(sharded(rebuilt(conversations), shards)))
    parts = found.filter("kind = 1").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("above").alias("above"),
    )
    saved = F.col("saved") - (F.col("n_convs") - 1) * F.col("above")
    open_ = durable(
        parts.withColumn("saved", saved).join(end_digests(found.filter("kind = 2")), "key", "left").withColumnRenamed("ends_sha256", "ends")
    )
    parents = open_.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    whole = found.filter("kind = 0")
    under = join_dimension(whole.filter("parent_key IS NOT NULL").drop("parent_conv_id"), parents, "parent_key")
    nodes = (
        whole.filter("parent_key IS NULL").select(*columns)
        .unionByName(under.select(*columns))
        .unionByName(open_.join(parents, "parent_key", "left").select(*columns))
    )
    return nodes.withColumnRenamed("saved", "saved_tokens").select(
        *columns[:6], "saved_tokens", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")
    )


ORACLE = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT conv_id, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))) AS crc
  FROM (SELECT DISTINCT conv_id FROM turns)
), convs AS (SELECT conv_id, xor(crc, 4294967295::BIGINT) % 4 AS h FROM hashed
), rebuilt AS (
  SELECT c.conv_id, k, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND k <= h
  UNION ALL
  SELECT c.conv_id, k, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND k > h
), named AS (
  SELECT conv_id, k, dense_rank() OVER (ORDER BY role, text) AS name,
         length(regexp_replace(regexp_replace(text, '{WORD}', 'w', 'g'), '{SPACE}', '', 'g')) AS words
  FROM rebuilt
), lists AS (SELECT conv_id, list(name ORDER BY k) AS names, list(words ORDER BY k) AS words FROM named GROUP BY conv_id
), sequences AS (
  SELECT conv_id, coalesce(names, []) AS names, coalesce(words, []) AS words FROM convs LEFT JOIN lists USING (conv_id)
), members AS (
  SELECT conv_id, names[1:d] AS path, d, len(names) AS n, words[d] AS words
  FROM (SELECT *, unnest(range(0, len(names) + 1)) AS d FROM sequences)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(words), 0) AS own,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM members GROUP BY path, d
), children AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path, d)
), below AS (
  SELECT path[1:a] AS path, a AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY ALL
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
       sha256(c.ends) AS ends_sha256
FROM counted c JOIN below USING (path, d) LEFT JOIN nodes p ON p.d = c.d - 1 AND p.path = c.path[1:c.d - 1]
"""
