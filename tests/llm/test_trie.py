"""The trie of conversations against its statement and against a plain trie in Python."""

import hashlib
import random
import zlib

import duckdb
import pytest

import oracle_check
from conftest import SMALL
from latewatch.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, shard string, kind string"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)


def same(df, docs):
    con = duckdb.connect()
    con.register("conversations", docs.toArrow())
    assert oracle_check.compare(df, con, prefix_trie.ORACLE) is None


def conversations(rng, n, deep=6, most=3):
    """Random short conversations over few turns, many of them equal."""
    return [
        (c, k, rng.choice(["user", "assistant"][: rng.randrange(1, 3)]), " ".join("abc"[: rng.randrange(most + 1)]))
        for c in range(n)
        for k in range(rng.randrange(deep))
    ]


def plain(rows):
    """Node figures from dictionaries: by smallest member and depth."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for path, ids in members.items():
        below = {p: m for p, m in members.items() if p[: len(path)] == path}
        ends = sorted(c for c in ids if len(whole[c]) == len(path))
        out.add((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(m) - 1) * len(p[-1][1].split()) for p, m in below.items() if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def test_query_equals_statement(spark):
    con = oracle_check.connect(SMALL)
    assert oracle_check.compare(queries.QUERIES["op13_prefix_trie"](spark, SMALL), con, queries.ORACLES["op13_prefix_trie"]) is None


@pytest.mark.parametrize("seed", range(3))
def test_random_tries_equal_dictionaries(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = conversations(rng, 150)
    monkeypatch.setattr(prefix_trie, "WIDTH", (2, 3, 16)[seed])
    monkeypatch.setattr(prefix_trie, "TURNS", (5, 20, 1000)[seed])
    docs = table(spark, rows)
    got = prefix_trie.trie(docs)
    assert {tuple(r) for r in got.collect()} == plain(rows)
    same(got, docs)


def test_open_nodes_over_many_shards(spark, monkeypatch):
    """Equal conversations fill shards, ends of one node come in several strings, and deep paths are shared."""
    monkeypatch.setattr(prefix_trie, "TURNS", 40)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(20 * c, k, "user", f"turn {k}") for c in range(120) for k in range(5)]
    rows += [(20 * c + 7, k, "user", f"turn {k} x") for c in range(200, 230) for k in range(40)]
    rows += [(20 * c + 7, k, "user", f"other {c}") for c in range(300, 320) for k in range(30)]
    docs = table(spark, rows)
    got = prefix_trie.trie(docs)
    assert {tuple(r) for r in got.collect()} == plain(rows)
    same(got, docs)


def test_tricky_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [
        (None, 0, "user", "lost"), (None, None, None, None), (0, None, "user", "first"), (0, 0, None, None), (0, 1, "", ""), (0, 2, "user", long),
        (1, 5, "user", "x"), (1, 5, "user", "x"), (1, 9, "user", "y"), (2, 0, "user", None), (25, 0, "user", " \n\t "), (26, 0, "é", "漢字 \x0b z"),
        (27, None, "u", "a"), (27, None, "u", "a"), (27, 3, "u", "b"), (-5, 0, "user", "q"), (-5, 1, "user", "r"), (-5, 2, "user", "s"), (-5, 3, "user", "t"),
        (45, 0, "user", "only one"), (46, 0, "user", "only one"), (46, -1, "user", "before"), (2**40, 0, "1:a", "b"), (2**40 + 1, 0, "1", ":ab"),
    ]
    docs = table(spark, rows)
    same(prefix_trie.trie(docs), docs)
    assert prefix_trie.trie(docs.limit(0)).count() == 0
    one = docs.filter("conv_id = 45")
    same(prefix_trie.trie(one), one)
