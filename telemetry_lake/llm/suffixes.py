"""Removal of long byte strings that an earlier document has, by column-wise multi-string suffix sorting.

A string of ``LENGTH`` bytes is removed where it also starts in a document with a smaller id; overlapping
strings cover their union, and all strings are judged on the input. Matches never cross documents.

1. Rows whose whole text an earlier document has are copies and need no search.
2. Every string has an anchor, its byte 16-gram of smallest hash. Runs of neighbouring strings share one, so a
   text has about one anchor in eighteen bytes. Two equal strings have, next to their anchor, at least half of their other
   bytes in common on one side; anchors are kept that two texts have together with one of these sides.
3. The strings of a kept anchor overlap and are one *context* of 50 to 84 bytes. Equal contexts are counted once,
   with the smallest id that has them.
4. The contexts of an anchor are a collection of short strings. Round by round one more symbol of every string,
   from the last to the first, goes into the collection's Burrows-Wheeler transform; the place follows from
   the transform itself, and the array of common prefixes is updated next to each insertion. In the end,
   neighbours with 50 common bytes are the same string, and the smallest id of each run is known. A context that has
   none of ``SIDES`` stretches around its anchor in common with another one shares no string with it, and is not sorted.
5. These ids go back to the contexts' places; a string there is removed if the id is smaller than its own.

Defined results: a NULL text is empty; texts shorter than ``LENGTH`` lose nothing; rows with a NULL id are left as
they are and remove nothing elsewhere; rows with one id and the same text are one document; equal ids are
never smaller than each other. Very long texts are cut into contexts like any other; empty tables stay empty. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from telemetry_lake.llm.common import flat, release, sized, slices, written
from telemetry_lake.llm.shingles import mix

LENGTH, GRAM = 50, 16
CHUNK_BYTES, PIECE_BYTES = 2 << 20, 1 << 20
# Contexts sorted together; one anchor's contexts are never parted.
COLLECTION = 16_384
# Stretches around an anchor, one of which two equal strings have in common: of all anchors, and of those that are kept.
ROUGH_SIDES, SIDES = 2, 4
END = 0  # symbol in front of a whole string


def sides(length: int, count: int) -> list[tuple[int, int]]:
    """Bytes before and after the anchor, by where it stands in a string: equal strings have those of one pair in common."""
    edges = [k * (length - GRAM + 1) // count for k in range(count + 1)]
    return [(a, length - GRAM - b + 1) for a, b in zip(edges, edges[1:], strict=False)]


def around(data: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the ``sides`` of the anchors at ``place``: hash of the stretch, and whether it lies in ``low..high``."""
    eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    out = []
    for before, after in sides(length, count):
        start, size = place - before, before + GRAM + after
        inside = (start >= low) & (start + size <= high)
        start = np.where(inside, start, 0)
        value = np.full(len(place), before, np.uint64)
        for at in (*range(0, size - 8, 8), size - 8):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + eight[np.minimum(start + at, len(data) - 1)])
        out.append((value, inside))
    return out


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of string starts with one anchor: document, first and last start (in ``data``), hash and place of the anchor."""
    found = []
    ends = np.repeat(offsets[1:], np.diff(offsets))
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    span = length - GRAM + 1
    for begin in range(0, max(0, len(data) - length + 1), PIECE_BYTES):
        part = data[begin : begin + PIECE_BYTES + length - 1]
        padded = np.concatenate([part, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        count = len(part) - GRAM + 1
        value = np.zeros(count, np.uint64)
        for at in (*range(0, GRAM - 8, 8), GRAM - 8):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + eight[at : at + count])
        place, width = np.arange(count, dtype=np.int32), 1
        low = value
        while width < span:  # smallest, leftmost gram of ever wider windows
            step = min(width, span - width)
            left = low[:-step] <= low[step:]
            place = np.where(left, place[:-step], place[step:])
            low = np.minimum(low[:-step], low[step:])
            width += step
        starts = begin + np.arange(len(place))
        inside = starts + length <= ends[starts]
        run = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (document[starts[1:]] != document[starts[:-1]]) | (inside[1:] != inside[:-1])]))
        last = np.append(run[1:], len(place)) - 1
        good = inside[run]
        run, last = run[good], last[good]
        found.append((document[begin + run], begin + run, begin + last, value[place[run]].view(np.int64), begin + place[run].astype(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


class Collection:
    """Burrows-Wheeler transform and common prefixes of many strings, built one symbol per string and round."""

    def __init__(self, strings: list[bytes]):
        m = len(strings)
        sizes = np.fromiter(map(len, strings), np.int64, m)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        text = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        text = np.append(text, np.uint16(END))

        def before(which: np.ndarray, taken: int) -> np.ndarray:
            """The symbol in front of the last ``taken`` ones."""
            at = sizes[which] - taken - 1
            return np.where(at >= 0, text[starts[which] + np.maximum(at, 0)], np.uint16(END)).astype(np.uint16)

        # At first the empty suffixes, in the order of their strings.
        self.string, self.taken = np.arange(m, dtype=np.int32), np.zeros(m, np.uint8)
        self.common = np.zeros(m, np.uint8)
        self.front = before(np.arange(m), 0)
        active, at = np.arange(m), np.arange(m)  # strings that go on, and where their last suffix stands
        for taken in range(1, int(sizes.max(initial=0)) + 1):
            going = sizes[active] >= taken
            active, at = active[going], at[going]
            self._insert(active, at, before(active, taken), taken, m)
            at = self.where

    def _insert(self, active: np.ndarray, at: np.ndarray, symbols: np.ndarray, taken: int, m: int) -> None:
        front, common = self.front, self.common
        order = np.argsort(front, kind="stable")
        skip = int(np.count_nonzero(front == END))  # whole strings have nothing in front
        rank = np.empty(len(front), np.int64)
        rank[order] = np.arange(len(front))
        own = rank[at]
        where = m + own - skip
        # Smallest common prefix of any range of neighbours: minima over powers of two.
        levels = [common]
        while 2 << (len(levels) - 1) <= len(common):
            reach = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-reach], levels[-1][reach:]))

        def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Common prefix of the new suffixes in front of neighbours a < b with the same symbol."""
            size = b - a
            level = np.frexp(size.astype(np.float64))[1] - 1
            out = np.empty(len(a), np.uint8)
            for k in np.unique(level).tolist():
                s = level == k
                out[s] = np.minimum(levels[k][a[s] + 1], levels[k][b[s] + 1 - (1 << k)])
            return np.minimum(out, 254) + np.uint8(1)

        previous = np.where(own > 0, order[np.maximum(own - 1, 0)], -1)
        same = (previous >= 0) & (front[previous] == front[at])
        with_previous = np.zeros(len(at), np.uint8)
        with_previous[same] = between(previous[same], at[same])
        following = order[np.minimum(own + 1, len(order) - 1)]
        same_after = (own + 1 < len(order)) & (front[following] == front[at])
        with_following = np.zeros(len(at), np.uint8)
        with_following[same_after] = between(at[same_after], following[same_after])

        size = len(front) + len(active)
        new = np.zeros(size, bool)
        new[where] = True
        old = ~new

        def merged(existing: np.ndarray, inserted: np.ndarray) -> np.ndarray:
            out = np.empty(size, existing.dtype)
            out[old] = existing
            out[where] = inserted
            return out

        self.front, self.string = merged(front, symbols), merged(self.string, active)
        self.taken = merged(self.taken, np.full(len(active), taken))
        self.common = merged(common, with_previous)
        after = where + 1
        stays = after < size
        self.common[after[stays]] = with_following[stays]
        self.where = where

    def smallest(self, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every suffix of ``length`` symbols or more: its string, its size, and the smallest owner of its start."""
        run = np.flatnonzero(np.concatenate([[True], self.common[1:] < length]))
        least = np.minimum.reduceat(owners[self.string], run)
        least = np.repeat(least, np.diff(np.append(run, len(self.string))))
        long = self.taken >= length
        return self.string[long], self.taken[long].astype(np.int64), least[long]


def context_minima(strings: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context the smallest owner of each of its strings, by start."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    which, taken, least = Collection(strings).smallest(owners, length)
    firsts = np.concatenate([[0], np.cumsum(sizes - length + 1)])
    out = np.empty(int(firsts[-1]), np.int64)
    out[firsts[which] + sizes[which] - taken] = least
    return [out[a:b] for a, b in zip(firsts, firsts[1:], strict=False)]


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("id"), F.xxhash64(t).alias("sum"), t.alias("text"))


def _numbers(document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Number of each run's anchor in its text; runs of one anchor may be parted, wherever a piece of the data ends."""
    new = np.concatenate([[True], (document[1:] != document[:-1]) | (place[1:] != place[:-1])])[: len(document)]
    number = np.cumsum(new)
    first = np.searchsorted(document, document)
    return number - number[first]


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """``(id, number, anchor, s0, s1)``: parts of the hashes of each text's anchors and of the stretches around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                data, offsets = flat(part.column("text"))
                document, _, _, value, place = anchored_runs(data, offsets, length)
                number = _numbers(document, place)
                one = np.concatenate([[True], (document[1:] != document[:-1]) | (number[1:] != number[:-1])])[: len(number)]
                document, value, place, number = document[one], value[one], place[one], number[one]
                found = around(data, place, offsets[document], offsets[document + 1], length, ROUGH_SIDES) if len(place) else []
                stretches = [pa.array(hashes.astype(np.uint32).view(np.int32), mask=~inside) for hashes, inside in found]
                stretches = stretches or [pa.array([], pa.int32())] * ROUGH_SIDES
                columns = [part.column("id").take(pa.array(document)), pa.array(number, pa.int32()), pa.array(value >> 40, pa.int32()), *stretches]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "number", "anchor", *[f"s{k}" for k in range(ROUGH_SIDES)]]
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *[T.StructField(name, T.IntegerType()) for name in names[1:]]]))


def _wanted(part: pa.RecordBatch, document: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether the bit of each anchor's number is set in its text's ``wanted``."""
    lists = part.column("wanted")
    flags = lists.flatten()
    words, bits = (field.to_numpy(zero_copy_only=False) for field in flags.flatten())
    keys = (np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy())) << 32) + words
    order = np.argsort(keys)
    keys, bits = keys[order], bits[order]
    own = (document << 32) + (number >> 6)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return (keys[at] == own) & ((bits[at] >> (number & 63)) & 1 == 1)


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """``(id, sum, start, hash, place, context, last)`` of the anchors in ``wanted``; starts count from the text's own, the
    place of the anchor from the context's. Of equal contexts of neighbouring texts only that of the smallest id has a
    ``last``, the greatest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                data, offsets = flat(part.column("text"))
                document, first, last, value, place = anchored_runs(data, offsets, length)
                keep = _wanted(part, document, _numbers(document, place))
                document, first, last, value, place = (x[keep] for x in (document, first, last, value, place))
                raw = data.tobytes()
                contexts = [raw[a : b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                at = pa.array(document)
                owner = part.column("id").take(at)
                ids = owner.to_numpy()
                ascending = np.argsort(ids, kind="stable").tolist()
                greatest = {contexts[i]: i for i in ascending}
                least = {contexts[i]: i for i in reversed(ascending)}
                lasts, leads = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
                for context, i in least.items():
                    lasts[i], leads[i] = ids[greatest[context]], True
                yield pa.RecordBatch.from_arrays(
                    [owner, part.column("sum").take(at), pa.array(first - offsets[document], pa.int64()), pa.array(value, pa.int64()),
                     pa.array(place - first, pa.int32()), pa.array(contexts, pa.binary()), pa.array(lasts, mask=~leads)],
                    names=["id", "sum", "start", "hash", "place", "context", "last"],
                )

    return rows.mapInArrow(run, T.StructType([
        rows.schema["id"], T.StructField("sum", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("hash", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("context", T.BinaryType()),
        T.StructField("last", T.LongType())]))


def _meeting(rows: pa.Table, length: int) -> np.ndarray:
    """Contexts that may share a string with another one of their anchor, by the stretches around it."""
    hashes = rows.column("hash").to_numpy()
    data, offsets = flat(rows.column("context").combine_chunks())
    place = rows.column("place").to_numpy() + offsets[:-1]
    out = np.zeros(len(hashes), bool)
    for value, inside in around(data, place, offsets[:-1], offsets[1:], length, SIDES):
        which = np.flatnonzero(inside)
        which = which[np.lexsort((value[which], hashes[which]))]
        same = (hashes[which[1:]] == hashes[which[:-1]]) & (value[which[1:]] == value[which[:-1]])
        out[which[1:][same]] = True
        out[which[:-1][same]] = True
    return out


def _sorted_minima(distinct: DataFrame, length: int) -> DataFrame:
    """``(hash, digest, owner, minima)`` of those distinct contexts ``(hash, place, context, owner, last)`` that lose a string
    somewhere; without ``minima`` their strings are all the owner's."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        owners, last = (rows.column(name).to_numpy() for name in ("owner", "last"))
        meets = np.flatnonzero(_meeting(rows, length))
        contexts = rows.column("context").take(pa.array(meets)).to_pylist()
        lists = dict(zip(meets.tolist(), context_minima(contexts, owners[meets], length), strict=True)) if len(meets) else {}
        least = owners.copy()
        for i, minima in lists.items():
            least[i] = minima.min()
            if (minima == owners[i]).all():
                lists[i] = None
        lose = np.flatnonzero(least < last)
        taken = [lists.get(i) for i in lose.tolist()]
        sizes = np.cumsum([0, *(0 if x is None else len(x) for x in taken)])
        ends = pa.array(sizes, pa.int32(), mask=np.array([*(x is None for x in taken), False]))
        some = [x for x in taken if x is not None]
        found = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(some) if some else [], pa.int64()))
        keys = [rows.column(name).combine_chunks().take(pa.array(lose)) for name in ("hash", "digest", "owner")]
        return pa.RecordBatch.from_arrays([*keys, found], names=["hash", "digest", "owner", "minima"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held < COLLECTION:
                continue
            rows = pa.Table.from_batches(waiting)
            hashes = rows.column("hash").to_numpy()
            edges = np.flatnonzero(hashes[1:] != hashes[:-1]) + 1  # the last anchor may go on
            done = 0
            while len(edges) and edges[-1] > done:
                cut = int(edges[max(np.searchsorted(edges, done + COLLECTION, "right") - 1, np.searchsorted(edges, done, "right"))])
                yield solve(rows.slice(done, cut - done))
                done = cut
            waiting, held = rows.slice(done).to_batches(), rows.num_rows - done
        if held:
            yield solve(pa.Table.from_batches(waiting))

    parts = distinct.sortWithinPartitions("hash").withColumn("digest", F.xxhash64("context"))
    return parts.mapInArrow(run, "hash bigint, digest bigint, owner bigint, minima array<bigint>")


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Adds ``n_bytes``, ``spans`` (start and end of removed runs) and ``kept``, from ``gone`` and ``copy``."""
    names = [c for c in rows.columns if c not in ("text", "gone", "copy", "sum")]
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]), False)
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("n_bytes", T.LongType(), False),
                           T.StructField("spans", spans, False), T.StructField("kept", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                sizes, found, kept = [], [], []
                for text, gone, copy in zip(part.column("text").cast(pa.large_binary()), part.column("gone"),
                                            part.column("copy"), strict=True):
                    raw = text.as_py()
                    own = []
                    if copy.as_py() and len(raw) >= length:
                        own = [(0, len(raw))]
                    elif gone.is_valid:
                        own = [(span["start"], span["end"]) for span in gone.as_py()]
                    pieces, done = [], 0
                    for a, b in own:
                        pieces.append(raw[done:a])
                        done = b
                    pieces.append(raw[done:])
                    sizes.append(len(raw))
                    found.append([{"start": a, "end": b} for a, b in own])
                    kept.append(b"".join(pieces))
                new = [pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *new], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def _shared_anchors(search: DataFrame, length: int) -> DataFrame:
    """The anchors that another text has with the same bytes on one side, ``(id, wanted)``: bits of their numbers, in words
    of 64. Texts of one id have them together."""
    anchors = _anchors(search, length).repartition("anchor")  # one exchange for all windows
    shared = F.lit(False)
    for k in range(ROUGH_SIDES):
        same = Window.partitionBy("anchor", f"s{k}")
        anchors = anchors.withColumn(f"shared{k}", F.min("id").over(same) < F.max("id").over(same))
        shared = shared | (F.col(f"s{k}").isNotNull() & F.col(f"shared{k}"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number").bitwiseAND(F.lit(63)))
    words = anchors.filter(shared).groupBy("id", F.shiftright("number", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    return words.groupBy("id").agg(F.collect_list(F.struct("word", "bits")).alias("wanted"))


def _distinct_contexts(contexts: DataFrame) -> DataFrame:
    """``(hash, place, context, owner, last)``: each context once, with the smallest and the greatest id that has it; those
    of an anchor in one partition."""
    leads = contexts.filter("last IS NOT NULL").select("hash", "place", "context", "id", "last").repartition("hash")
    return leads.groupBy("hash", "place", "context").agg(F.min("id").alias("owner"), F.max("last").alias("last"))


def _runs(found: DataFrame) -> DataFrame:
    """Runs of removed string starts, ``(id, sum, first, last)``, of contexts of ``n`` strings at ``start`` with their
    ``minima``, or without them of contexts that are removed whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.filter(batch.column("minima").is_null())
            ends = pa.array(whole.column("start").to_numpy() + whole.column("n").to_numpy() - 1, pa.int64())
            yield pa.RecordBatch.from_arrays([whole.column(c) for c in ("id", "sum", "start")] + [ends], names=["id", "sum", "first", "last"])
            batch = batch.filter(batch.column("minima").is_valid())
            counts = np.diff(batch.column("minima").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), counts)
            within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            gone = batch.column("minima").flatten().to_numpy() < batch.column("id").to_numpy()[row]
            row, at = row[gone], batch.column("start").to_numpy()[row[gone]] + within[gone]
            fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)])[: len(row)]
            last = np.append(np.flatnonzero(fresh)[1:], len(row)) - 1 if len(row) else np.zeros(0, np.int64)
            own = pa.array(row[fresh])
            columns = [batch.column("id").take(own), batch.column("sum").take(own), pa.array(at[fresh], pa.int64()), pa.array(at[last], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "sum", "first", "last"])

    schema = [found.schema["id"], *[T.StructField(name, T.LongType()) for name in ("sum", "first", "last")]]
    return found.mapInArrow(run, T.StructType(schema))


def _spans(runs: DataFrame, length: int) -> DataFrame:
    """The removed spans of each text, ``(id, sum, spans)``: runs in order, put together where their strings overlap
    or touch. A text's runs are sorted by Spark, however many there are."""
    of_text = Window.partitionBy("id", "sum").orderBy("first", "last")
    ahead = F.max("last").over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    parted = runs.withColumn("new", (ahead.isNull() | (F.col("first") > ahead + length)).cast("int"))
    parted = parted.withColumn("span", F.sum("new").over(of_text.rowsBetween(Window.unboundedPreceding, 0)))
    spans = parted.groupBy("id", "sum", "span").agg(F.min("first").alias("start"), (F.max("last") + length).alias("end"))
    return spans.groupBy("id", "sum").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))


def _removed_spans(contexts: DataFrame, minima: DataFrame, length: int) -> DataFrame:
    n = F.octet_length("context") - (length - 1)
    places = contexts.select("id", "sum", "start", n.cast("long").alias("n"), "hash", F.xxhash64("context").alias("digest"))
    found = places.join(minima, ["hash", "digest"]).filter("minima IS NOT NULL OR owner < id")
    return _spans(_runs(found.select("id", "sum", "start", "n", "minima")), length)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_bytes, spans, kept)`` per row. ``length`` lies between 17 and 110."""
    if not GRAM < length <= 110:
        raise ValueError("the length must lie between 17 and 110")
    spark, rows = docs.sparkSession, _keyed(docs, text, key)
    whole = rows.filter("id IS NOT NULL").select("id", "sum", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("sha"))
    twice = written(whole.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last"), "suffix-twice")
    copies = whole.join(sized(twice), "sha").filter("id > first").select("id", "sum").distinct()
    copies = sized(written(copies.withColumn("copy", F.lit(True)), "suffix-copies"))
    search = rows.filter("id IS NOT NULL").filter(F.octet_length("text") >= length).join(copies, ["id", "sum"], "left_anti")

    shared = sized(written(_shared_anchors(search, length), "suffix-anchors"), 2 * F.size("wanted"))
    release(spark)
    contexts = written(_contexts(search.join(shared, "id"), length), "suffix-contexts")
    release(spark)
    minima = written(_sorted_minima(_distinct_contexts(contexts), length), "suffix-minima")
    release(spark)
    gone = sized(written(_removed_spans(contexts, minima, length), "suffix-spans"), 2 * F.size("gone"))
    release(spark)
    final = rows.join(gone, ["id", "sum"], "left").join(copies, ["id", "sum"], "left")
    return _cut(final, length).withColumnRenamed("id", key)
