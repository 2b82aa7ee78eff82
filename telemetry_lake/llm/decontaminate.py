"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are brought to a canonical form: A-Z lower-cased, every run of non-word bytes one blank, a blank at both
ends. A pattern is a window of ten consecutive words of a benchmark item (an item of fewer words is one pattern),
with its outer blanks. Patterns of similar length share a table set. A table of shifts by the hash of a block of
bytes tells how far the search may jump; where the shift is zero, the bucket of patterns with that last block is
taken, a prefix of eight bytes thins it out, and direct comparison confirms the occurrence.

The jumps are made for many stretches of text at once: each stretch has a cursor, and one numpy step moves
every cursor by its own shift.

Defined results: NULL and empty texts have no words and no hits; items of NULL text or without words have no
patterns; an item without an id marks hit words like any other, and is not in the item ids; equal items are all
reported; repeated documents are reported alike; an empty benchmark hits nothing, and empty documents stay empty. Very long
texts are searched whole, in stretches.
Columns of the input other than the text are kept, and must not bear one of the names added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.common import flat, give_back, slices

WINDOW = 10
# Bytes of benchmark text whose tables a task holds at a time, and bytes of documents searched at a time.
BLOCK_BYTES, CHUNK_BYTES = 16 << 20, 4 << 20
# Text positions each cursor covers, and the bits of the shift table's index.
STRETCH, TABLE_BITS = 4096, 20
# Least pattern length of each table set; patterns of one set are cut to the shortest for the shifts.
LENGTH_CLASSES = (3, 8, 16, 32)
MIX = np.uint64(0x9E3779B97F4A7C15)

ADDED = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])), False),
    T.StructField("item_ids", T.ArrayType(T.StringType()), False),
])

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def canonical(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in canonical form end to end, each behind a zero byte."""
    count = len(offsets) - 1
    out = np.full(len(data) + 3 * count, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(3 * np.arange(count) + 2, np.diff(offsets))] = _FOLD[data]
    out[offsets[:-1] + 3 * np.arange(count)] = 0
    blank = out == 32
    blank[1:] &= blank[:-1].copy()
    blank[0] = False
    return out[~blank]


def patterns_of(text: str | None, window: int = WINDOW) -> list[bytes]:
    """The distinct patterns of an item."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    words = canonical(data, np.array([0, len(data)])).tobytes()[1:].split()
    last = max(1, len(words) - window + 1) if words else 0
    return list(dict.fromkeys(b" " + b" ".join(words[i : i + window]) + b" " for i in range(last)))


def _words64(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number; ``text`` needs eight spare bytes at its end."""
    return np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))


class WuManber:
    """Tables of one length class. ``find`` yields start positions and pattern numbers."""

    def __init__(self, patterns: list[bytes], numbers: np.ndarray):
        self.patterns, self.numbers = patterns, numbers
        self.length = min(map(len, patterns))
        self.block = min(6, max(2, self.length // 3))
        self.cut = np.uint64((1 << (8 * self.block)) - 1)
        self.prefix_cut = np.uint64((1 << (8 * min(8, self.length))) - 1)
        most = self.length - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, most, np.int32)
        heads = np.array([np.frombuffer(p[: self.length].ljust(self.length + 8, b"\0"), np.uint8) for p in patterns])
        for at in range(most):
            values = self._number(heads, at) & self.cut
            np.minimum.at(self.shift, self._slot(values), np.int32(most - 1 - at))
        last = self._number(heads, most - 1) & self.cut
        order = np.argsort(last, kind="stable")
        self.order, self.last = order, last[order]
        self.prefix = (self._number(heads, 0) & self.prefix_cut)[order]

    @staticmethod
    def _number(rows: np.ndarray, at: int) -> np.ndarray:
        return np.ascontiguousarray(rows[:, at : at + 8]).view("<u8")[:, 0]

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return ((values * MIX) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def zero_shifts(self, padded: np.ndarray, size: int) -> np.ndarray:
        """Window starts at which no shift is possible, out of ``size`` bytes followed by eight spare ones."""
        stops = size - self.length + 1
        if stops <= 0:
            return np.zeros(0, np.int64)
        wide, found = _words64(padded), []
        cursor = np.arange(0, stops, STRETCH)
        limit = np.minimum(cursor + STRETCH, stops)
        tail = self.length - self.block
        while len(cursor):
            jump = self.shift[self._slot(wide[cursor + tail] & self.cut)]
            found.append(cursor[jump == 0])
            cursor = cursor + np.maximum(jump, 1)
            inside = cursor < limit
            cursor, limit = cursor[inside], limit[inside]
        return np.sort(np.concatenate(found))

    def find(self, padded: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        starts = self.zero_shifts(padded, size)
        wide = _words64(padded)
        last = wide[starts + self.length - self.block] & self.cut
        low, high = np.searchsorted(self.last, last, "left"), np.searchsorted(self.last, last, "right")
        prefix = wide[starts] & self.prefix_cut
        step = 0
        while len(starts):
            # One pattern of each bucket per step, until the largest bucket is used up.
            left = low + step < high
            starts, low, high, prefix = starts[left], low[left], high[left], prefix[left]
            near = self.prefix[low + step] == prefix
            for start, at in zip(starts[near].tolist(), self.order[low[near] + step].tolist(), strict=True):
                pattern = self.patterns[at]
                if padded[start : start + len(pattern)].tobytes() == pattern:
                    yield start, int(self.numbers[at])
            step += 1


class Matcher:
    """All table sets of a block of benchmark items ``(item_id, text)``."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        owners: dict[bytes, list[str | None]] = {}
        for item, text in items:
            for pattern in patterns_of(text, window):
                owners.setdefault(pattern, []).append(item)
        self.lengths = [len(p) for p in owners]
        self.owners = list(owners.values())
        patterns = list(owners)
        sizes = np.array(self.lengths)
        self.tables = []
        for least, most in zip(LENGTH_CLASSES, (*LENGTH_CLASSES[1:], 1 << 62), strict=True):
            chosen = np.flatnonzero((sizes >= least) & (sizes < most)) if len(sizes) else []
            if len(chosen):
                self.tables.append(WuManber([patterns[i] for i in chosen], np.asarray(chosen)))

    def find(self, padded: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        for tables in self.tables:
            yield from tables.find(padded, size)


_MATCHERS: dict[int, Matcher] = {}


def _matcher(block) -> Matcher:
    if block.value[0] not in _MATCHERS:
        _MATCHERS.clear()  # one block's tables at a time
        _MATCHERS[block.value[0]] = Matcher(*block.value[1:])
    return _MATCHERS[block.value[0]]


def search(column: pa.Array, blocks: list) -> list[tuple[int, int, list[tuple[int, int]], list[str]]]:
    """Words, hit words, hit spans (word numbers from 0, both included) and item ids of each text."""
    data, offsets = flat(column)
    text = canonical(data, offsets)
    size = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    starts = np.flatnonzero(text == 0)
    word = (text != 32) & (text != 0)
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    upto = np.concatenate([[0], np.cumsum(begins)])  # words that begin before a position
    first_word = upto[np.append(starts, size)]
    marks = np.zeros(int(upto[-1]) + 1, np.int64)
    items: dict[int, set[str | None]] = {}
    for block in blocks:
        matcher = _matcher(block)
        for start, number in matcher.find(padded, size):
            a, b = upto[start + 1], upto[start + matcher.lengths[number] - 1]
            marks[a] += 1
            marks[b] -= 1
            doc = int(np.searchsorted(starts, start, "right")) - 1
            items.setdefault(doc, set()).update(matcher.owners[number])
    hit = np.cumsum(marks)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    out = []
    for doc in range(len(starts)):
        a, b = int(first_word[doc]), int(first_word[doc + 1])
        spans = []
        if doc in items:
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
            spans = [(int(x), int(y) - 1) for x, y in zip(edges[::2], edges[1::2], strict=True)]
        out.append((b - a, int(total[b] - total[a]), spans, sorted(items.get(doc, set()) - {None})))
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` of hit words and ``item_ids`` (sorted as strings).

    The benchmark is a stated set of patterns: it is read in blocks of bounded size, each broadcast for
    itself, and a task holds the tables of one block at a time.
    """
    if clash := set(ADDED.fieldNames()) & set(docs.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    context = docs.sparkSession.sparkContext
    blocks, own, total = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").orderBy("item")

    def close() -> None:
        blocks.append(context.broadcast((hash((len(blocks), id(blocks), tuple(own))), list(own), window)))
        own.clear()

    for row in rows.toLocalIterator():
        size = len(row.text or "")
        if own and total + size > BLOCK_BYTES:
            close()
            total = 0
        own.append((row.item, row.text))
        total += size
    if own:
        close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for part in slices(batch, text, CHUNK_BYTES):
                found = search(part.column(text), blocks)
                n_words, n_hit, spans, items = zip(*found, strict=True) if found else ((), (), (), ())
                spans = [[{"first_word": a, "last_word": b} for a, b in own] for own in spans]
                kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())]))
                new = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, kind),
                       pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *ADDED.fieldNames()])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *ADDED.fields]))
