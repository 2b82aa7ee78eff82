"""Sets of hashed word shingles of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from telemetry_lake.llm.common import flat

# Bytes whose words are hashed in one go; a longer word is hashed with all its bytes.
PIECE_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers; equal numbers stay equal, others stay apart."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text in bytes, A-Z lower-cased."""
    out, start = [], 0
    while start < len(data):
        stop = min(len(data), start + PIECE_BYTES)
        while stop < len(data):  # a piece ends with a blank
            blank = np.flatnonzero(_BLANK[data[start:stop]])
            if len(blank):
                stop = start + int(blank[-1]) + 1
                break
            stop = min(len(data), stop + PIECE_BYTES)
        part = _LOWER[data[start:stop]]
        word = ~_BLANK[part]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        # Sums of byte times power of its place; shifted back to the word's start they depend on its bytes alone.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(part)), dtype=np.uint64)])
        value = (sums[last] - sums[first]) * _powers(_INVERSE, len(part))[first]
        out.append(mix(value + (last - first).astype(np.uint64)))
        start = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of fewer words, the whole sequence as one."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    value = mix(words[:count] + np.uint64(size))
    for i in range(1, size):
        value = mix(value * np.uint64(0x100000001B3) + words[i : i + count])
    return np.unique(value)


def sets_of(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of every text, in order; NULL and texts without words have an empty one."""
    data, offsets = flat(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield shingles(word_hashes(data[a:b]), size)
