import random

import pyarrow as pa

from latewatch.llm import words as w


def shingles(text, k=5):
    parts = text.split(" ") if text else []
    parts = [p for p in text.replace("\n", " ").replace("\t", " ").split(" ") if p]
    if not parts:
        return []
    return [tuple(parts[i : i + k]) for i in range(max(1, len(parts) - k + 1))]


def test_words_and_runs_equal_python(monkeypatch):
    rng = random.Random(3)
    vocabulary = ["a", "b", "é", "über", "x9", "$$"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    texts += ["", " ", "\n\t", "a", " a b ", "a  b\nc", "word" * 3000]
    rng.shuffle(texts)
    monkeypatch.setattr(w, "SLICE", 500)
    w._powers.clear()
    seen = {}
    column = pa.array(["skipped", *texts])[1:]
    for first, last, data, offsets in w.slices(column):
        found = w.words(data, offsets)
        part = texts[first:last]
        assert list(found.counts) == [len(t.split()) for t in part]
        assert [bytes(data[a:b]).decode() for a, b in zip(found.starts, found.ends)] == [x for t in part for x in t.split()]
        hashes, of, at = found.runs(found.hashes(), 5, short=True)
        by_text = {}
        for h, t in zip(hashes.tolist(), of.tolist()):
            by_text.setdefault(t, []).append(h)
        for k, t in enumerate(part):
            expected, got = shingles(t), by_text.get(k, [])
            assert len(expected) == len(got)
            for e, g in zip(expected, got):
                assert seen.setdefault(e, g) == g
    assert len(set(seen.values())) == len(seen)
    w._powers.clear()


def test_no_texts():
    assert list(w.slices(pa.array([], pa.string()))) == []
