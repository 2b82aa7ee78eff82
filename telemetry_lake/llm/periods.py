"""Periodic runs of words, found online along sparse diagonals.

Word i and an earlier occurrence of it at i - d lie on the diagonal of lag d. The walk over a text's words keeps the
diagonals that matched at the word before: an earlier occurrence either lengthens the match of its diagonal or opens
one; a diagonal that the word does not lengthen ends, and is emitted there and then if its run is long enough.

Which earlier occurrences count is what keeps this sparse. A run of smallest period q and at least 4 q words holds 3 q
matches in a row. Take k = 1, 3, 9, ... with q <= k <= 3 q: inside the run the word and the k - 1 words before it occur
q words earlier, and not nearer, because a stretch of at least one period repeats only after whole periods. So for each
k only the nearest earlier occurrence of a word *in the context of its last k words* is taken, and only if its lag is
more than k / 3 and at most k. That is at most one occurrence per word and k, of a logarithmic number of k, instead of
all occurrences of a frequent word; no run is lost, and every emitted period is the smallest of its stretch. Contexts
are numbered exactly, k from k / 3, and those that occur once are dropped on the way.

Defined results: NULL and empty texts, and texts without words, have no words and no runs and collapse to ''. Runs are
ordered by start, then period; overlapping runs are all reported, and a word is dropped if any run repeats it. Repeated
rows are treated alike, each for itself; a very long text is a batch of its own, whole; empty tables give empty
results. Other columns are kept, and must not bear one of the names added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from telemetry_lake.llm.common import slices

BATCH_BYTES = 4 << 20
# A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
ADDED = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(RUN, False), False),
    T.StructField("collapsed", T.BinaryType(), False),
])


def occurrences(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Earlier occurrences that a run may rest on, as ``(word, lag, context length)`` ordered by word.

    ``codes`` are the word numbers of texts that lie end to end; ``starts`` are the texts' first words and the end.
    """
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    size = np.diff(starts)[text]
    at = np.arange(len(codes))
    rank = _numbered(text * (int(codes.max(initial=0)) + 1) + codes)
    found, context = [], 1
    while len(at):
        order = np.lexsort((at, rank))
        same = rank[order][1:] == rank[order][:-1]
        before = np.full(len(at), -1)
        before[order[1:][same]] = at[order[:-1][same]]
        lag = at - before
        fits = (before >= 0) & (lag * 3 > context) & (lag <= context)
        found.append(np.stack([at[fits], lag[fits], np.full(int(fits.sum()), context)]))
        # Contexts three times as long, of words whose own context occurs more than once.
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        lookup = np.full(len(codes), -1)
        lookup[at[again]] = rank[again]
        middle, context = context, 3 * context
        at = at[again & (size[at] * 3 >= (context + 3) * LEAST_PERIODS) & (at - starts[text[at]] >= context - 1)]
        at = at[(lookup[at - middle] >= 0) & (lookup[at - 2 * middle] >= 0)]
        span = len(codes) + 1
        rank = _numbered(_numbered(lookup[at - 2 * middle] * span + lookup[at - middle]) * span + lookup[at])
    word, lag, context = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((lag, word))
    return word[order], lag[order], context[order]


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def walk(words: list[int], lags: list[int], contexts: list[int]) -> Iterator[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` from the earlier occurrences of a text's words, each when it ends."""
    active: dict[int, int] = {}  # match length by lag, of the diagonals that the last word lengthened
    last = -2

    def ended() -> Iterator[tuple[int, int, int]]:
        for lag, matched in active.items():
            if matched + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                yield last + 1 - matched - lag, matched + lag, lag

    i, count = 0, len(words)
    while i < count:
        word = words[i]
        if word != last + 1:
            yield from ended()
            active = {}
        lengthened = {}
        while i < count and words[i] == word:
            lag = lags[i]
            # An occurrence in context opens its diagonal with all words of the context matched.
            lengthened[lag] = active.pop(lag) + 1 if lag in active else contexts[i]
            i += 1
        yield from ended()
        active, last = lengthened, word
    yield from ended()


def find(texts: list[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs, ordered by start and period, of each text."""
    words = [text.split() for text in texts]  # blanks of byte strings are the six of ASCII
    starts = np.cumsum([0, *map(len, words)])
    if not starts[-1]:
        return [(own, []) for own in words]
    every = pa.array([word for own in words for word in own], pa.large_binary())
    codes = every.dictionary_encode().indices.to_numpy().astype(np.int64)
    at, lag, context = occurrences(codes, starts)
    bounds = np.searchsorted(at, starts)
    out = []
    for own, start, low, high in zip(words, starts.tolist(), bounds.tolist(), bounds[1:].tolist(), strict=False):
        part = slice(low, high)
        out.append((own, sorted(walk((at[part] - start).tolist(), lag[part].tolist(), context[part].tolist()), key=lambda r: (r[0], r[2]))))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run repeats."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change)[:-1] > 0
    return b" ".join([word for word, gone in zip(words, dropped.tolist(), strict=True) if not gone])


def periodic_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (start word, length, smallest period) and ``collapsed``, the text's words
    without what runs repeat, joined by blanks."""
    if clash := set(ADDED.fieldNames()) & set(df.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    kind = pa.list_(pa.field("element", pa.struct([pa.field(name, pa.int64(), False) for name in RUN.names]), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                found = find(part.column(text).cast(pa.large_binary()).fill_null(b"").to_pylist())
                new = [
                    pa.array([len(words) for words, _ in found], pa.int64()),
                    pa.array([[dict(zip(RUN.names, run, strict=True)) for run in runs] for _, runs in found], kind),
                    pa.array([collapse(words, runs) for words, runs in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *ADDED.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *ADDED.fields]))
