"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Every pre-token keeps its pieces in a linked list. A bucket per merge rank holds the list positions whose pair
has that rank, and a two-level bitmap has a bit per bucket with entries: find-first-set on the upper word, then
on the lower one, names the lowest rank in constant time. Entries of pairs that a merge has changed stay where
they are and are skipped when they come up. The work is n log n in the length of a pre-token, whatever its content.
Short pre-tokens share one queue, so that a step merges the same rank in all of them with a few numpy calls.

Defined results: NULL and empty texts give no ids and decode to empty bytes; repeated rows are encoded alike;
other columns of the input are kept as they are (they must not be called ``ids`` or ``decoded``); empty tables stay empty.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from telemetry_lake.llm.common import give_back, slices

# Pre-tokens after which a worker forgets what it knows, before the next run of texts.
CACHE_SIZE = 1 << 17
# Bytes of text encoded together; the queue's arrays take some fifty times that.
BATCH_BYTES = 1 << 20
# Pre-tokens of up to so many bytes are merged together, longer ones alone.
SHORT = 64
# No rank: a pair that does not merge, a wall between pre-tokens, a symbol that is gone.
NONE = -1
# Longer texts are split into pre-tokens piecemeal instead of into one list.
LONG_TEXT, RUN = 1 << 20, 1 << 16


def parse_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Token bytes and rank per line, in base 64 and decimal."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}


# Texts of these characters only are split with the standard library, in which letters and digits are spelled out.
LATIN = re.compile("[\\t-\\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
LATIN_LETTERS, LATIN_DIGITS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9"


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts that match ``LATIN``; None if it has classes other than letters and numbers."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{LATIN_LETTERS}{LATIN_DIGITS}]")
    plain = plain.replace(r"\p{L}", f"[{LATIN_LETTERS}]").replace(r"\p{N}", f"[{LATIN_DIGITS}]")
    known = not re.search(r"\\[^sS]|\(\?[^!]", plain)
    return re.compile(plain) if known else None


class Bitmap:
    """A set of ranks in two levels of words; ``lowest`` finds the first set bit of each level."""

    def __init__(self, ranks: int):
        self.shift = max(1, ((ranks - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.shift) - 1
        self.upper = 0
        self.lower = [0] * ((ranks >> self.shift) + 1)

    def add(self, rank: int) -> None:
        word = rank >> self.shift
        self.lower[word] |= 1 << (rank & self.mask)
        self.upper |= 1 << word

    def remove(self, rank: int) -> None:
        word = rank >> self.shift
        self.lower[word] &= ~(1 << (rank & self.mask))
        if not self.lower[word]:
            self.upper &= ~(1 << word)

    def lowest(self) -> int:
        word = (self.upper & -self.upper).bit_length() - 1
        bits = self.lower[word]
        return (word << self.shift) | ((bits & -bits).bit_length() - 1)


class RankQueue:
    """Positions of one pre-token by merge rank. ``pop`` yields the lowest rank, and its leftmost position."""

    def __init__(self, ranks: int):
        self.bits = Bitmap(ranks)
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self.bits.add(rank)
        else:
            heapq.heappush(bucket, position)

    def pop(self) -> tuple[int, int]:
        rank = self.bits.lowest()
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.bits.remove(rank)
        return rank, position


class BucketQueue:
    """Positions of many pre-tokens by merge rank. ``pop`` yields the lowest rank and its whole bucket."""

    def __init__(self, ranks: int):
        self.bits = Bitmap(ranks)
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        real = ranks >= 0
        ranks, positions = ranks[real], positions[real]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        first = np.concatenate([[0], np.flatnonzero(ranks[1:] != ranks[:-1]) + 1])
        edges = [*first.tolist(), len(ranks)]
        for rank, a, b in zip(ranks[first].tolist(), edges, edges[1:], strict=False):
            self.put_back(rank, positions[a:b])

    def put_back(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.bits.add(rank)
        else:
            bucket.append(positions)

    def pop(self) -> tuple[int, np.ndarray]:
        rank = self.bits.lowest()
        self.bits.remove(rank)
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.latin = latin_pattern(pattern)
        self.size = max(ranks.values(), default=0) + 1
        self.queue = RankQueue(self.size)
        self.known: dict[str, tuple[int, ...]] = {}
        # Rank of every token as the pair of any two tokens it can be cut into, by the pair's number.
        pairs = sorted(
            (self.ranks[token[:cut]] * self.size + self.ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        )
        self.pair_keys = np.array([key for key, _ in pairs] + [1 << 62], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs] + [NONE], np.int64)
        self.byte_ids = np.array([ranks.get(bytes([b]), NONE) for b in range(256)], np.int64)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token of any length."""
        rank_of, queue = self.ranks.get, self.queue
        n = len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair: list[int | None] = [None] * n  # rank of the pair that starts here
        for i in range(n - 1):
            rank = rank_of(data[i : i + 2])
            if rank is not None:
                pair[i] = rank
                queue.push(rank, i)
        while queue.bits.upper:
            rank, i = queue.pop()
            if pair[i] != rank:
                continue  # stale: a merge has changed or removed this pair
            gone = after[i]
            end = after[gone]
            after[i], pair[gone] = end, None
            if end < n:
                before[end] = i
                new = rank_of(data[i : after[end]])
                if new is not None:
                    queue.push(new, i)
                pair[i] = new
            else:
                pair[i] = None
            left = before[i]
            if left >= 0:
                new = rank_of(data[left:end])
                if new is not None:
                    queue.push(new, left)
                pair[left] = new
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[data[i : after[i]]])
            i = after[i]
        return ids

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of many short pre-tokens: their lists lie end to end, parted by a symbol that pairs with nothing.

        A step takes the bucket of the lowest rank and merges its leftmost live entry of every pre-token.
        """
        data = np.frombuffer(b"\0".join([b"", *pieces, b""]), np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        walls = np.concatenate([[0], np.cumsum(lengths + 1)])
        symbol = self.byte_ids[data]
        symbol[walls] = NONE
        owner = np.repeat(np.arange(len(pieces) + 1), np.append(lengths + 1, 1))
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        pair = np.append(self.pair_rank(symbol[:-1], symbol[1:]), NONE)
        queue = BucketQueue(self.size)
        queue.push(pair, np.arange(len(pair)))
        while queue.bits.upper:
            rank, entries = queue.pop()
            entries = entries[pair[entries] == rank]  # the others are stale
            if len(entries) > 1:
                entries.sort()
                own = owner[entries]
                later = np.concatenate([[False], own[1:] == own[:-1]])
                if later.any():
                    queue.put_back(rank, entries[later])
                    entries = entries[~later]
            if not len(entries):
                continue
            gone = after[entries]
            end, left = after[gone], before[entries]
            after[entries], before[end] = end, entries
            pair[gone], symbol[gone], symbol[entries] = NONE, NONE, rank
            merged = np.full(len(entries), rank)
            pair[entries] = on_right = self.pair_rank(merged, symbol[end])
            pair[left] = on_left = self.pair_rank(symbol[left], merged)
            queue.push(np.concatenate([on_right, on_left]), np.concatenate([entries, left]))
        live = symbol >= 0
        ids = symbol[live].tolist()
        stops = np.concatenate([[0], np.cumsum(live)])[walls].tolist()
        return [ids[a:b] for a, b in zip(stops, stops[1:], strict=False)]

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of all these pre-tokens among the known ones."""
        short, data = [], []
        for text in pieces:
            own = text.encode("utf-8", "replace")
            whole = self.ranks.get(own)
            if whole is not None:
                self.known[text] = (whole,)
            elif len(own) > SHORT:
                self.known[text] = tuple(self.merge(own))
            else:
                short.append(text)
                data.append(own)
        if short:
            self.known.update(zip(short, map(tuple, self.merge_all(data)), strict=True))

    def split(self, text: str) -> list[str]:
        if self.latin and LATIN.fullmatch(text):
            return self.latin.findall(text)
        return self.pattern.findall(text)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        out = []
        if len(self.known) > CACHE_SIZE:
            self.known.clear()
        cut = [self.split(text) if len(text) <= LONG_TEXT else None for text in texts]
        self.learn(set().union(*(pieces for pieces in cut if pieces)).difference(self.known))
        for text, pieces in zip(texts, cut, strict=True):
            if pieces is not None:
                out.append(list(chain.from_iterable(map(self.known.__getitem__, pieces))))
                continue
            ids: list[int] = []
            found = (m[0] for m in self.pattern.finditer(text))
            while run := list(islice(found, RUN)):
                if len(self.known) > CACHE_SIZE + (1 << 18):
                    self.known.clear()
                    self.learn(set().union(*(pieces for pieces in cut if pieces)))
                self.learn(set(run).difference(self.known))
                ids.extend(chain.from_iterable(map(self.known.__getitem__, run)))
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def encoder_for(vocabulary: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (hash(vocabulary), hash(pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(vocabulary), pattern)
    return _ENCODERS[key]


def encode_decode(df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids array<int>``, the encoded text, and ``decoded binary``, the bytes these ids stand for.

    The vocabulary, whose size is fixed by its file, is read on the driver and broadcast.
    """
    for name in ("ids", "decoded"):
        if name in df.columns:
            raise ValueError(f"the input already has a column {name}")
    with open(vocabulary_path, "rb") as file:
        vocabulary = df.sparkSession.sparkContext.broadcast(file.read())
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder = encoder_for(vocabulary.value, pattern)
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                raw = part.column(text).cast(pa.large_binary()).fill_null(b"").to_pylist()
                ids, decoded = [], []
                for own in encoder.encode_all([value.decode("utf-8", "replace") for value in raw]):
                    ids.append(pa.array(own, pa.int32()))
                    decoded.append(encoder.decode(own))
                columns = [*part.columns, _lists(ids), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "ids", "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def _lists(values: list[pa.Array]) -> pa.Array:
    offsets = [0]
    for value in values:
        offsets.append(offsets[-1] + len(value))
    flat = pa.concat_arrays(values) if values else pa.array([], pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
