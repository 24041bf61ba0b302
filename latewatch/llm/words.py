"""Words of many texts at once, in numpy: borders, hashes and hashes of runs of words.

Works on the bytes of an Arrow column; a word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return. Texts are taken in slices of a few MB, so that memory does not follow the size of a batch; only a single
text larger than that makes a slice of its own size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from latewatch.llm.inputs import TaskCache

SLICE = 2 << 20
U64 = np.uint64

_random = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
PLACES = _random.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_VALUES[BLANK] = 0
_MULTIPLIER = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = TaskCache()


def scramble(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all others (the finaliser of SplitMix64)."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


def _powers_for(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept for slices of the usual size."""
    need = max(size, SLICE)
    if need in _powers:
        return _powers[need]
    pair = []
    for base in (_MULTIPLIER, _INVERSE):
        out = np.full(need, base, dtype=np.uint64)
        out[0] = 1
        pair.append(np.multiply.accumulate(out))
    if need == SLICE:
        _powers[need] = (pair[0], pair[1])
    return pair[0], pair[1]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, bytes, offsets`` of runs of texts; offsets start at 0. The column has no nulls."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """Borders of all words of a slice; ``counts``: words of each text, ``first``: the number of its first word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A hash of the bytes of each word, wherever it stands."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = _powers_for(len(self.data))
        values = BYTE_VALUES[self.data]
        values *= up[: len(values)]
        return scramble(np.add.reduceat(values, self.starts) * down[self.starts])

    def runs(self, hashes: np.ndarray, length: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of each run of ``length`` words inside a text. ``short``: a text with fewer words
        has them all as its one run (none without words)."""
        n, counts = len(hashes), self.counts
        sizes = np.maximum(counts - length + 1, 0)
        places = np.arange(n)
        left = np.repeat(self.first + counts, counts) - places  # words from here to the end of the text
        at = places[left >= length]
        out = np.zeros(len(at), np.uint64)
        for k in range(length):
            out += hashes[at + k] * PLACES[k]
        texts = np.repeat(np.arange(len(counts)), sizes)
        if short and (few := np.flatnonzero((counts > 0) & (counts < length))).size:
            extra = np.zeros(len(few), np.uint64)
            for k in range(length - 1):
                has = counts[few] > k
                extra[has] += hashes[self.first[few[has]] + k] * PLACES[k]
            extra += counts[few].astype(np.uint64) * PLACES[length]
            out, texts, at = np.concatenate([out, extra]), np.concatenate([texts, few]), np.concatenate([at, self.first[few]])
        return scramble(out), texts, at


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts that stand one after another in ``data``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(BLANK[data], out=inside[1:-1])
    body = inside[1:-1]
    borders = np.zeros(len(data) + 1, dtype=bool)
    borders[offsets] = True
    starts = np.flatnonzero(body & (~inside[:-2] | borders[:-1]))
    ends = np.flatnonzero(body & (~inside[2:] | borders[1:])) + 1
    first = np.searchsorted(starts, offsets[:-1])
    counts = np.diff(np.append(first, len(starts)))
    return Words(data, offsets, starts, ends, counts, first)
