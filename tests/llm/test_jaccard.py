"""The shingle join against all pairs, its bounds and its counting argument."""

import random

import numpy as np
import pytest

from conftest import SMALL
from latewatch.llm import jaccard_join as join
from latewatch.llm import links, queries
from tricky_rows import no_docs, tricky  # noqa: F401  the fixtures


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower(text)) if w]
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def all_pairs(rows):
    """(doc_id, set size, smallest id reachable) of each row, comparing all rows."""
    sets_ = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets_):
        for j in range(i):
            b = sets_[j]
            if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)) and top(i) != top(j):
                if 100 * len(a & b) >= 85 * len(a | b):
                    parent[top(i)] = top(j)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        smallest.setdefault(top(k), []).append(doc_id)
    smallest = {k: min((d for d in ids if d is not None), default=None) for k, ids in smallest.items()}
    return sorted(((d, len(s), smallest[top(k)]) for k, (d, s) in enumerate(zip([d for d, _ in rows], sets_))), key=str)


def run(docs):
    return sorted((tuple(r) for r in join.join_components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def variants(rng, size, n, most):
    """Texts with up to so many words changed, so that similarities lie on both sides of the threshold."""
    base = [f"w{rng.randrange(60)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(size), rng.randrange(most + 1)):
            words[at] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words[: size - rng.randrange(1 + size // 10)]))
    return out


def test_query_equals_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.QUERIES["op11_jaccard_join"](spark, SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == all_pairs(rows)


@pytest.mark.parametrize("rounds", [0, 2])
def test_dense_clouds_equal_all_pairs(spark, rounds, monkeypatch):
    """Without rounds, tiles find all links by themselves."""
    monkeypatch.setattr(links, "ROUNDS", rounds)
    monkeypatch.setattr(links, "BLOCK", 16)
    rng = random.Random(5 + rounds)
    found = [t for size in (4, 8, 9, 10, 13, 17, 30, 47, 90, 200) for t in variants(rng, size, 40, max(1, size // 30))]
    found += [t.upper() for t in found[:30]] + [" ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(40))) for _ in range(60)]
    common = " ".join(f"c{k}" for k in range(40))
    found += [common + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 40))) for _ in range(120)]
    rng.shuffle(found)
    rows = list(enumerate(found))
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == all_pairs(rows)


@pytest.mark.parametrize("size", [6, 7, 8, 9, 12, 20, 34, 60, 150, 700])
def test_linked_sets_share_a_bucket(size):
    """Sets at exactly the smallest similarity that links, of all sizes, share a key."""
    rng = np.random.default_rng(size)
    cut = join.bands()
    for _ in range(60):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        larger = int(rng.integers(size, size * 100 // 85 + 1))
        shared = -(-85 * (size + larger) // 185)
        if shared > size:
            continue
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, larger - shared, dtype=np.uint64)])
        of = np.repeat([0, 1], [size, larger])
        sizes = np.array([size, larger])
        found = [join.part_keys(np.concatenate([a, b]), of, band, cut) for band in (cut.of(sizes), cut.below(sizes))]
        keys, text = (np.concatenate(x) for x in zip(*found))
        assert set(keys[text == 0].tolist()) & set(keys[text == 1].tolist())


def test_bounds_are_not_below_overlaps():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
    arrays = [np.sort(rng.choice(pool, rng.integers(1, 250), replace=False)) for _ in range(40)]
    bits = rng.choice([64, 128, 512], 40)
    sizes = np.array([len(a) for a in arrays])
    maps = join.bitmaps(np.concatenate(arrays), np.repeat(np.arange(40), sizes), bits)
    bounds = join.overlap_bounds(sizes, [np.frombuffer(m, np.uint8) for m in maps])
    for i, x in enumerate(arrays):
        for j, y in enumerate(arrays):
            true = len(set(x.tolist()) & set(y.tolist()))
            assert links.overlap(x, y) == true <= bounds[i, j] <= min(len(x), len(y))


def test_tricky_rows(spark, tricky, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in tricky.collect()]
    assert run(tricky) == all_pairs(rows)
    assert join.join_components(no_docs).count() == 0
