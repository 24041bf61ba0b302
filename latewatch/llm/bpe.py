"""BPE encoding and decoding with an index of pair occurrences.

A task collects the distinct chunks (runs between blanks) of a batch, cuts them into words as the tokenizer file says,
and encodes all new words of the batch together. The symbols of all those words stand in one array, linked to their
neighbours; an index maps the rank of each pair to all positions where the pair occurs. Active ranks are taken in
ascending order from a heap; all occurrences of a rank are joined at once, and the pairs that come into being at their
borders go into the index. Positions that an earlier rank has used up are recognised when their turn comes. Texts are
then put together from the ids of their chunks.

Texts are read whole. Memory of a task: a batch, and the ids of at most ``MOST_CHUNKS`` distinct chunks, after which
they are gathered anew. The tokenizer's file is named by a parameter and read by every task; there is no shuffle.

Supported files: model BPE with a word-end suffix over byte symbols, normaliser NFC and lower case, words by a pattern
that never crosses blanks, no decoder (decoding joins the tokens' strings by one blank), special tokens matched in the
raw text. Other files are refused.

Defined results: null and empty texts and texts of blanks have no ids and decode to an empty text; repeated rows are
encoded alike; an empty table gives an empty result; other columns of the table are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import TaskCache, by_size, texts

MOST_CHUNKS = 250_000
#: Blanks to Python but not to the tokenizer's pattern.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_BLANKS = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, other = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], other = chr(other), other + 1
    return [letters[b] for b in range(256)]


class Tokenizer:
    """The tables of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        steps = [n["type"] for n in held["normalizer"]["normalizers"]]
        cuts = held["pre_tokenizer"]["pretokenizers"]
        if (model["type"], steps, [c["type"] for c in cuts], held["decoder"]) != ("BPE", ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], None):
            raise ValueError(f"{path}: not a file of the supported kind")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = regex.compile(cuts[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, k in (*vocab.items(), *self.special.items()):
            self.tokens[k] = token
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last_ids = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.joined = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        keys = self.left * self.size + self.right
        self.rank_order = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_order[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of ids of each word. No word is empty."""
        pieces = [w.encode("utf-8") for w in words]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        lasts = np.cumsum(lengths) - 1
        firsts = lasts - lengths + 1
        symbols = self.byte_ids[data]
        symbols[lasts] = self.last_ids[data[lasts]]
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        after[lasts], before[firsts] = -1, -1
        live = np.ones(len(data), dtype=bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Pairs that begin at these positions go into the index."""
            ranks = self.ranks(symbols[at], symbols[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, group in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts) if len(cuts) else [at]):
                if rank in index:
                    index[rank].append(group)
                else:
                    index[rank] = [group]
                    heapq.heappush(active, rank)

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            held = index.pop(rank)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            a, b = self.left[rank], self.right[rank]
            at = at[live[at] & (symbols[at] == a) & (after[at] >= 0)]
            at = at[symbols[after[at]] == b]
            if len(at) > 1:  # a pair between two occurrences of an earlier rank was entered from either side
                at.sort()
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            if a == b and len(at) > 1:  # in a run of one symbol, pairs are taken from the left and do not overlap
                taken, used = [], -1
                for p in at.tolist():
                    if p != used:
                        taken.append(p)
                        used = int(after[p])
                at = np.array(taken, dtype=np.int64)
            if not len(at):
                continue
            gone = after[at]
            follow = after[gone]
            symbols[at], live[gone], after[at] = self.joined[rank], False, follow
            more = follow >= 0
            before[follow[more]] = at[more]
            prior = before[at]
            enter(np.concatenate([prior[prior >= 0], at[more]]))
        return symbols[live], np.add.reduceat(live, firsts, dtype=np.int64) if len(firsts) else lengths

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # letter by letter: this letter has another small form only where it ends a word
                text = text.replace("Σ", "σ")
        return text.lower()

    def chunks(self, text: str) -> list[str | int]:
        """Runs between blanks, in lower case; a special token is its id."""
        if "<" not in text or not self.special_pattern.search(text):
            return self._split(self.normal(text))
        out: list[str | int] = []
        start = 0
        for found in self.special_pattern.finditer(text):
            out += self._split(self.normal(text[start : found.start()]))
            out.append(self.special[found.group()])
            start = found.end()
        return out + self._split(self.normal(text[start:]))

    @staticmethod
    def _split(text: str) -> list[str]:
        return [c for c in _BLANKS.split(text) if c] if _SEPARATORS.search(text) else text.split()


class Numbers(dict):
    """Numbers keys as they come."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def spread(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` with these starts and lengths, one after another."""
    total = np.cumsum(lengths)
    return values[np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)]


class ChunkTable(dict):
    """Numbers chunks as they come and holds their ids one after another."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer = tokenizer
        self.fresh: list[str | int] = []
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, chunk: str | int) -> int:
        number = self[chunk] = len(self)
        self.fresh.append(chunk)
        return number

    def encode_fresh(self) -> None:
        """Ids of the chunks that have come since the last call."""
        words = Numbers()
        of_chunk: list[int] = []  # words of the chunks one after another; a special token is -1 - id
        sizes: list[int] = []
        find = self.tokenizer.pattern.findall
        for chunk in self.fresh:
            if isinstance(chunk, int):
                of_chunk.append(-1 - chunk)
                sizes.append(1)
            elif chunk.isalpha():
                of_chunk.append(words[chunk])
                sizes.append(1)
            else:
                parts = find(chunk)
                of_chunk += map(words.__getitem__, parts)
                sizes.append(len(parts))
        ids, counts = self.tokenizer.encode_words(list(words))
        numbers = np.array(of_chunk, dtype=np.int64)
        special = numbers < 0
        starts, lengths = np.append(0, np.cumsum(counts))[np.where(special, 0, numbers)], np.ones(len(numbers), np.int64)
        if len(counts):
            lengths = np.where(special, 1, counts[np.where(special, 0, numbers)])
        ends = np.append(0, np.cumsum(lengths))
        flat = spread(ids if len(ids) else np.zeros(1, np.int64), starts, lengths)
        flat[ends[:-1][special]] = -1 - numbers[special]
        self.ids = np.concatenate([self.ids, flat.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends[np.cumsum(np.array(sizes, dtype=np.int64))]])
        self.fresh = []

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of chunks one after another."""
        return spread(self.ids, self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers])


_tokenizers = TaskCache()


def tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def encode_batch(values: list[str], table: ChunkTable) -> list[np.ndarray]:
    """Ids of each text."""
    chunks = table.tokenizer.chunks
    numbers = []
    for text in values:
        parts = chunks(text)
        numbers.append(np.fromiter(map(table.__getitem__, parts), np.int64, len(parts)))
    table.encode_fresh()
    return [table.gather(n) for n in numbers]


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches with the ids of their texts (column 1)."""
    table = ChunkTable(tokenizer(path))
    for batch in batches:
        for part in by_size(batch, 1):
            if len(table) > MOST_CHUNKS:
                table = ChunkTable(tokenizer(path))
            yield part, encode_batch(part.column(1).to_pylist(), table)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: ``ids`` is an array of integers."""
    path = path or tokenizer_path()
    rows = texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the tokens' strings joined by one blank. Null ids decode to an empty text."""
    path = path or tokenizer_path()
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(path).tokens
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):  # the strings of a whole batch would be many times its ids
                part = batch.slice(start, 1_000)
                lists = part.column(1)
                ids, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                texts = [" ".join(map(tokens.__getitem__, ids[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: ``doc_id, ids, decoded``."""
    path = path or tokenizer_path()
    rows = texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(path).tokens
        for part, ids in _encoded(batches, path):
            decoded = [" ".join(map(tokens.__getitem__, i.tolist())) for i in ids]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """Of (doc_id, ids, decoded): ``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``."""
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
