"""Words of whole texts as 64-bit hashes, in numpy: the inner loop of the operators that run Arrow batches.

A word is a maximal run of bytes other than space and tab to carriage return. All texts of a batch are hashed together over
their UTF-8 bytes; the batch is cut between documents so that the arrays stay small. A word's hash is a sum over its bytes
of a random value per byte times a power per place, then mixed; places count from the start of the slice and are divided
out by the inverse power, so there is no loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS.copy()
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the finisher of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_ROOT))


class _Powers(dict):
    """Tables made so far; each worker makes its own."""

    def __reduce__(self) -> tuple:
        return _Powers, ()


_powers = _Powers()


def powers(root: int, n: int) -> np.ndarray:
    """root^0 ... root^(n-1) modulo 2^64."""
    have = _powers.get(root)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        have = np.full(size, root, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:
            _powers[root] = have
    return have[:n]


@dataclass
class Slice:
    """Some documents: rows first to last - 1 of the batch, their words' hashes, and where each document's words begin.

    data: the documents' bytes as given; begins, ends: where each word lies in them.
    """

    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def _hash(data: np.ndarray, edges: np.ndarray, lower: bool) -> tuple[np.ndarray, ...]:
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    word = ~space
    start = word.copy()
    start[1:] &= space[:-1]
    inner = edges[(edges < len(data)) & (edges > 0)]
    start[inner] = word[inner]
    end = np.zeros(len(data) + 1, dtype=bool)
    end[1:] = word
    end[1:-1] &= space[1:] | start[1:]
    begins, ends = np.flatnonzero(start), np.flatnonzero(end)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_ROOT, len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[begins]) * powers(_ROOT_INVERSE, len(data))[begins] + (ends - begins).astype(np.uint64))
    return hashes, np.searchsorted(begins, edges), begins, ends


def slices(texts: pa.Array | pa.ChunkedArray, lower: bool = True) -> Iterator[Slice]:
    """The batch's documents in order; a null text has no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1)
        edges = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        hashes, bounds, begins, ends = _hash(part, edges, lower)
        yield Slice(first, last, hashes, bounds, part, begins, ends)
        first = last


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on (the last n - 1 places are left out), whatever the documents."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        total *= _U(_ROOT)
        total += hashes[j : j + size]
    return mix(total)


def inside(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from which n words lie in one document, and the document of each."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][doc], doc


def whole(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each document's whole word sequence."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_ROOT, len(hashes)), out=sums[1:])
    counts = np.diff(bounds).astype(np.uint64)
    back = np.ones(len(bounds) - 1, np.uint64)
    full = bounds[:-1] < len(hashes)
    back[full] = powers(_ROOT_INVERSE, len(hashes))[bounds[:-1][full]]
    return mix((sums[bounds[1:]] - sums[bounds[:-1]]) * back + counts * _U(_ROOT))
