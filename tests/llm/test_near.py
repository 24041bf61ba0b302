"""Near duplicates against all pairs, the signature's mean, components, and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from latewatch.llm import bag_minhash as near
from latewatch.llm import links
from latewatch.llm.graph import components
from tricky_rows import no_docs, tricky  # noqa: F401  the fixtures


def shingles(text):
    words = text.split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def all_pairs(texts):
    """Class (smallest id) of every id by comparing all pairs that share a shingle."""
    bags = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by_shingle, seen = {}, set()
    for k, bag in bags.items():
        for s in bag:
            by_shingle.setdefault(s, []).append(k)
    for ids in by_shingle.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if similarity(bags[a], bags[b]) >= 0.8:
                        x, y = sorted((top(a), top(b)))
                        parent[y] = x
    return {k: top(k) for k in texts}


def test_a_dense_cloud_equals_all_pairs(spark):
    """Variants of one text at similarities on both sides of 0.8, chains among them, and many exact copies."""
    rng = random.Random(8)
    base = [rng.choice(["so", "it", "went", "on", "and", "all", "were"]) + str(rng.randrange(40)) for _ in range(120)]
    texts, k = {}, 0
    for _ in range(150):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randrange(0, 7)):
            words[at] = f"new{rng.randrange(10**6)}"
        texts[k] = " ".join(words)
        k += 1
    for _ in range(60):
        texts[k] = " ".join(base)
        k += 1
    for _ in range(40):
        texts[k] = " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))
        k += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()} == all_pairs(texts)


def test_a_large_class_is_joined_by_few_pairs(spark, monkeypatch):
    """4,000 near copies of one text: one class, at most one pair a text and round, one or two links a text."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(100)]
    texts = []
    for _ in range(4000):
        words = list(base)
        words[rng.randrange(100)] = f"new{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    pairs, found = [], []
    verified = links.verified

    def counted(asked, *rest):
        pairs.append(asked.count())
        out = verified(asked, *rest)
        found.append(out.count())
        return out

    monkeypatch.setattr(links, "verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert {r["class_id"] for r in near.near_classes(docs).collect()} == {0}
    assert all(n <= 4000 for n in pairs) and sum(found) <= 2 * 4000


def test_tiles_are_bounded_in_shingles(spark):
    rows = [(7, k, 100_000, max(k, 9)) for k in range(60)]
    members = spark.createDataFrame(rows, "key long, node long, weight long, label long")
    tiles = links.tiles(members, members.selectExpr("node", "binary('') AS sketch")).collect()
    assert max(len(t["held"]) for t in tiles) * 100_000 < 4 * links.BLOCK_WEIGHT < 60 * 100_000
    pairs = Counter()
    for t in tiles:
        node, label, side = (np.array([h[k] for h in t["held"]]) for k in ("node", "label", "side"))
        pairs.update(tuple(sorted((int(node[i]), int(node[j])))) for i, j in zip(*np.nonzero(links.allowed(label, side))))
    assert pairs == Counter((a, b) for a in range(60) for b in range(a + 1, 60) if max(a, 9) != max(b, 9))


def test_classes_do_not_depend_on_the_weight_of_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()}
    monkeypatch.setattr(links, "BLOCK_WEIGHT", 50)
    assert {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()} == before


def test_small_tables_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = near.near_classes(docs).collect()
    expected = all_pairs(texts)
    assert {r["doc_id"]: r["class_id"] for r in got} == expected
    sizes = Counter(expected.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))


def test_registers_agree_as_often_as_multisets_are_similar():
    """Unbiased for sets, multisets and large counts."""
    rng = np.random.default_rng(5)
    m = 4000
    for counts_a, counts_b in (([1] * 30, [1] * 20 + [0] * 10), ([3, 1, 7, 2], [1, 1, 9, 0]), ([40, 5], [25, 9]), ([1], [6])):
        elements = rng.integers(0, 2**62, len(counts_a)).astype(np.uint64)
        hashes = np.concatenate([np.repeat(elements, counts_a), np.repeat(elements, counts_b)])
        of = np.repeat([0, 1], [sum(counts_a), sum(counts_b)])
        names, total = near.signatures(hashes, of, 2, m)
        expected = np.minimum(counts_a, counts_b).sum() / np.maximum(counts_a, counts_b).sum()
        assert total.tolist() == [sum(counts_a), sum(counts_b)]
        assert abs((names[0] == names[1]).mean() - expected) < 0.035


def test_the_sketch_loses_hardly_a_pair():
    registers = near.BANDS * near.ROWS
    least = math.ceil(near.sketch_cut(0.8) * registers)
    assert sum(math.comb(registers, k) * 0.8**k * 0.2 ** (registers - k) for k in range(least)) < 2e-6


def test_overlaps_equal_counters():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found, of = links.distinct(*near.shingle_hashes(data, np.cumsum([0, *map(len, texts)])), repeated=True)
    arrays = np.split(found, np.searchsorted(of, np.arange(1, 60)))
    shared, sizes = near.shared_counts(arrays)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            a, b = shingles(x), shingles(y)
            assert links.overlap(arrays[i], arrays[j]) == sum((a & b).values()) and sizes[i] == sum(a.values())
            if i != j:
                assert shared[i, j] == sum((a & b).values())


def test_in_company_keeps_shared_keys(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(300), node) for node in range(250)] + [(7, node) for node in range(1000, 1400)]
    entries = spark.createDataFrame(rows, "key long, node long").repartition(5)
    got = [tuple(r) for r in links.in_company(entries).collect()]
    by_key = Counter(k for k, _ in rows)
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert {r for r in rows if by_key[r[0]] > 1} <= set(got)
    assert sum(by_key[k] == 1 for k, _ in got) <= 2 * 8
    assert links.in_company(entries.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(300, 301), (301, 300), (302, 301)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300, 302: 300}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_tricky_rows(tricky, no_docs):
    rows = near.near_classes(tricky).collect()
    assert len(rows) == tricky.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r["class_id"])
    assert by_id[1] == [1] and by_id[2] == [1, 1] and by_id[3] == [1] and sorted(by_id[9]) == [9, 9]
    assert by_id[4] == [4] and by_id[5] == [4] and by_id[6] == [6] and sorted(map(str, by_id[None])) == ["1", "4", "4"]
    kept = near.keep_one(tricky)
    assert kept.columns == tricky.columns and kept.count() == 11
    assert near.near_classes(no_docs).count() == 0 and near.keep_one(no_docs).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if name != "bpe":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    assert set(kept[1]) <= set(kept[0]) and set(kept[2]) <= set(kept[1]) and set(kept[3]) <= set(kept[2])
    assert Counter(kept[4]) == Counter(kept[3]) and len(set(kept[2])) == len(kept[2])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/1").collect()}
    assert sorted(kept[2]) == sorted(set(all_pairs(texts).values()))


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_sends_texts_in_modest_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.range(3_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), "id").alias("text"))
    sizes = lambda: max(r.n for r in rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect())
    before = spark.conf.get(name)
    try:
        for held, most in (("10000", 1_000), ("0", 1_000), ("300", 300)):
            spark.conf.set(name, held)
            assert corpus_pipeline.encode(spark, rows, "").count() == 3_000
            assert sizes() == most
    finally:
        spark.conf.set(name, before)
