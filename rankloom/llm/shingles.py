"""Sets of word shingles as sorted 64-bit hashes, made for whole slices of texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from rankloom.llm import batches

WHITE = np.zeros(256, bool)
WHITE[list(b" \t\n\v\f\r")] = True
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# Coefficients of the hashes: any odd numbers would do, the same ones everywhere.
BASE = np.uint64(0x9E3779B97F4A7C15)
# A longer text is hashed a stretch at a time.
STRETCH_BYTES = 4 << 20
BYTE_VALUES = batches.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte ranges, from prefix sums."""
    n = 1 << max(len(data), 1).bit_length()
    inverse = pow(int(BASE), -1, 1 << 64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers(int(BASE), n)[: len(data)], dtype=np.uint64)])
    plain = (sums[ends] - sums[starts]) * powers(inverse, n)[starts]
    return batches.mix(plain + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the words before each text's start."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if len(offsets) == 2 and len(data) > STRETCH_BYTES:
        return long_word_hashes(data)
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    first = np.flatnonzero(starts)
    return range_hashes(LOWER[data], first, np.flatnonzero(ends) + 1), np.searchsorted(first, offsets)


def long_word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes`` of one long text, in stretches that end before white space."""
    found, start = [], 0
    while start < len(data):
        end = min(start + STRETCH_BYTES, len(data))
        while end < len(data) and not WHITE[data[end]]:
            end += 1
        part = data[start:end]
        first = np.flatnonzero(~WHITE[part] & np.append(True, WHITE[part[:-1]]))
        last = np.flatnonzero(~WHITE[part] & np.append(WHITE[part[1:]], True)) + 1
        found.append(range_hashes(LOWER[part], first, last))
        start = end
    words = np.concatenate(found)
    return words, np.array([0, len(words)])


def sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted, in a row, and where each set starts and ends.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without words
    has none.
    """
    words, edges = word_hashes(data, offsets)
    factors = powers(int(BASE) * 3 & (1 << 64) - 1, width + 1)[1:]
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for i in range(width):
        rolled += words[i : i + len(rolled)] * factors[i]
    rolled = batches.mix(rolled)
    parts, sizes = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= width:
            found = np.unique(rolled[a : b - width + 1])
        elif b > a:
            found = batches.mix((words[a:b] * factors[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            found = rolled[:0]
        parts.append(found)
        sizes.append(len(found))
    whole = np.concatenate(parts) if parts else rolled[:0]
    return whole, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
