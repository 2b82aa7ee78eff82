"""Hashed character n-grams of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes handled in one go; longer texts are parted, at a blank if there is one near.
PIECE_BYTES = 1 << 18

# Letters, digits and all bytes beyond ASCII stay, A-Z in lower case; everything else is a blank.
FOLD = np.full(256, 32, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts of about ``PIECE_BYTES``: folded bytes with a blank before, between and behind the parts,
    and the text each byte belongs to. A text longer than that comes in several runs."""
    texts, total = [], 0

    def close():
        sizes = np.array([len(part) + 1 for _, part in texts])
        joined = np.full(int(sizes.sum()) + 1, 32, np.uint8)
        at = np.concatenate([[0], np.cumsum(sizes)])
        for (_, part), start in zip(texts, at, strict=False):
            joined[start + 1 : start + 1 + len(part)] = FOLD[part]
        owner = np.repeat(np.array([i for i, _ in texts]), sizes)
        return joined, np.append(owner, owner[-1])

    for i in range(len(offsets) - 1):
        start, stop = int(offsets[i]), int(offsets[i + 1])
        while stop - start > PIECE_BYTES:
            cut = start + PIECE_BYTES
            blanks = np.flatnonzero(FOLD[data[cut - 4096 : cut]] == 32)
            cut = cut - 4096 + int(blanks[-1]) + 1 if len(blanks) else cut
            if texts:
                yield close()
            texts, total = [(i, data[start:cut])], cut - start
            start = cut
        if texts and total + stop - start > PIECE_BYTES:
            yield close()
            texts, total = [], 0
        texts.append((i, data[start:stop]))
        total += stop - start
    if texts:
        yield close()


def hashed(joined: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n of ``sizes`` the positions and buckets of the n-grams that lie in one word.

    A gram may begin with the blank before its word or end with the blank behind it.
    """
    blanks = np.concatenate([[0], np.cumsum(joined == 32, dtype=np.int32)])
    value, n = joined.astype(np.uint32), 1
    state = value.copy()
    for wanted in sorted(sizes):
        while n < wanted:
            state = state[:-1] * np.uint32(0x01000193) + value[n:]
            n += 1
        count = len(state)
        if count <= 0:
            return
        if n == 1:
            inside = value != 32
        elif n == 2:
            inside = (value[:-1] != 32) | (value[1:] != 32)
        else:  # no blank but at the ends
            inside = blanks[n - 1 : n - 1 + count] == blanks[1 : 1 + count]
        at = np.flatnonzero(inside)
        mixed = (state[at] + np.uint32(n)) * np.uint32(0x9E3779B1)
        yield at, (mixed >> np.uint32(32 - bits)).astype(np.int64)
