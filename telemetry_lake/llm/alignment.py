"""Alignment of two tokenizers' tokens by divide and conquer at the byte offsets where both end a token.

Tokenizer A (byte-level BPE) encodes blank + text, tokenizer B (sentence pieces, which put the blank there themselves)
encodes the text. An interval of tokens whose last end is shared is cut in two at the shared end next to its middle:
candidates are the ends of A, from the middle outwards; each is looked up among the ends of B by bisection, once and in
ascending order, so that neighbouring bisections touch the same numbers. Both halves are cut in turn; an interval without
a shared end inside is a leaf, one group of tokens of A and B. All intervals of a batch of texts are cut in step, so that
a step is a few numpy calls. In a leaf the tokens overlap in a staircase: the union of both sides' ends parts it into
stretches, each of which links one token of A with one of B.

How often two ids are linked in the whole corpus is counted from the written links of each text (``linked_pairs``).
``weigh`` brings these counts back to the texts: pairs that hold at least a 2^20th of all links are at most 2^20 and
are broadcast; all others meet their counts by a shuffled join, in which no pair has more than that share.

Defined results: NULL and empty texts, and texts of which either side's tokens do not spell blank + text byte by byte,
have no tokens, groups or links. Tokenizers' special strings inside texts are text. Repeated rows are aligned alike and
counted each; very long texts are aligned whole, in a batch of their own; ties for the highest count of an id of B are
all best; empty tables give empty results. Other columns are kept, and must not bear one of the names added.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.common import slices, written

# Bytes of text aligned at a time; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
# Longer texts are encoded by the slower library of the vocabulary file, which takes any run of blanks.
LONG_TEXT = 50_000
# A pair is broadcast with its count if it holds at least one in so many links; so these are at most as many pairs.
HEAVY_SHARE = 1 << 20

LINK = T.StructType([T.StructField(name, T.IntegerType(), False) for name in ("a", "b", "times")])
ADDED = T.StructType([
    *(T.StructField(name, T.LongType(), False) for name in ("n_a", "n_b", "n_groups", "n_links")),
    T.StructField("groups", T.StringType(), False),
    T.StructField("links", T.ArrayType(LINK, False), False),
])


def shared_ends(a: np.ndarray, b: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Indices into ``a`` of the ends that are also in ``b``, for intervals ``first..stop`` whose last end is shared.

    ``a`` and ``b`` are ascending byte offsets of token ends of texts that lie end to end.
    """
    shared = b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a if len(b) else np.zeros(len(a), bool)
    cuts = [stop - 1]
    lo, hi = first, stop - 1  # ends lo..hi-1 are inside the interval
    while (some := lo < hi).any():
        lo, hi = lo[some], hi[some]
        cut = _near_middle(shared, lo, hi)
        found = cut >= 0  # the other intervals are leaves
        lo, hi, cut = lo[found], hi[found], cut[found]
        cuts.append(cut)
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut, hi])
    return np.sort(np.concatenate(cuts))


def _near_middle(shared: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval the index of an end that is ``shared`` among ``lo..hi-1`` that is nearest to its middle, or -1.

    The distances tried double from round to round, so a leaf of n ends takes log n rounds.
    """
    result = np.full(len(lo), -1)
    middle = (lo + hi) // 2
    open_, reach, tried = np.arange(len(lo)), 1, 0
    while len(open_):
        low, high, mid = lo[open_], hi[open_], middle[open_]
        left = np.maximum(mid - reach + 1, low)
        if tried:  # the stretch on the left that is new, then the one on the right
            counts = np.stack([np.maximum(mid - tried + 1 - left, 0), np.maximum(np.minimum(mid + reach, high) - mid - tried, 0)], 1)
            starts = np.stack([left, mid + tried], 1)
        else:
            counts, starts = np.stack([np.minimum(mid + reach, high) - left], 1), np.stack([left], 1)
        per = counts.sum(1)
        flat_counts = counts.ravel()
        total = int(per.sum())
        ahead = np.cumsum(flat_counts) - flat_counts
        at = np.repeat(starts.ravel() - ahead, flat_counts) + np.arange(total)
        hit = shared[at]
        if hit.any():
            owner = np.repeat(np.arange(len(open_)), per)[hit]
            at = at[hit]
            order = np.lexsort((at, np.abs(at - mid[owner]), owner))
            nearest = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
            result[open_[owner[nearest]]] = at[nearest]
        more = (result[open_] < 0) & ((mid - reach >= low) | (mid + reach < high))
        open_, tried, reach = open_[more], reach, 2 * reach + 1
    return result


class Tokens:
    """Ids, byte ends and spelling of one tokenizer's tokens of many texts, one behind the other."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.names = pa.array([str(i) for i in range(len(spelled))], pa.string())

    def spells(self, ids: list[int], own: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == own

    def joined(self, ids: np.ndarray, stops: np.ndarray) -> pa.Array:
        """Comma-joined ids of each group; ``stops`` are the groups' ends."""
        offsets = np.concatenate([[0], stops]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.names.take(pa.array(ids))), ",")


def byte_alphabet() -> dict[str, int]:
    """The characters byte-level vocabularies write bytes as: printable ones as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {**{chr(byte): byte for byte in plain}, **{chr(256 + i): byte for i, byte in enumerate(others)}}


class Aligner:
    """Both tokenizers of a worker, and the alignment of batches of texts."""

    def __init__(self, byte_vocabulary: bytes, piece_model: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        described = json.loads(byte_vocabulary)
        special = {token["content"] for token in described["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(map(alphabet.__getitem__, name)): i for name, i in described["model"]["vocab"].items() if name not in special}
        spelled = [b""] * (max(ranks.values()) + 1)
        for name, i in ranks.items():
            spelled[i] = name
        self.a = Tokens(spelled)
        # Ids of this kind of vocabulary are in the order of their merges, which is what ranks are.
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_buffer(byte_vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b = Tokens([
            bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ])

    def encode(self, text: str) -> list[int]:
        """Ids of A; the text begins with the blank."""
        if len(text) <= LONG_TEXT:
            return self.encoding.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def align(self, texts: list[bytes | None]) -> list[pa.Array]:
        """The columns of ``ADDED`` for these texts."""
        all_a, all_b = [], []
        for own in texts:
            ids_a, ids_b = [], []
            if own:
                text = own.decode("utf-8", "replace")
                spelled = b" " + own
                ids_b = self.pieces.encode(text)
                if self.b.spells(ids_b, spelled):
                    ids_a = self.encode(" " + text)
                if not self.a.spells(ids_a, spelled):
                    ids_a, ids_b = [], []
            all_a.append(ids_a)
            all_b.append(ids_b)
        n_a = np.fromiter(map(len, all_a), np.int64, len(texts))
        n_b = np.fromiter(map(len, all_b), np.int64, len(texts))
        ids_a = np.fromiter((i for ids in all_a for i in ids), np.int64, int(n_a.sum()))
        ids_b = np.fromiter((i for ids in all_b for i in ids), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        some = n_a > 0
        stops_a = np.cumsum(n_a)
        cuts = shared_ends(ends_a, ends_b, (stops_a - n_a)[some], stops_a[some]) if some.any() else np.zeros(0, np.int64)
        group_a = cuts + 1
        group_b = np.searchsorted(ends_b, ends_a[cuts]) + 1
        text_groups = np.searchsorted(cuts, stops_a)  # groups up to the end of each text
        n_groups = np.diff(text_groups, prepend=0)
        joined = pc.binary_join_element_wise(self.a.joined(ids_a, group_a), self.b.joined(ids_b, group_b), "|")
        offsets = pa.array(np.concatenate([[0], text_groups]).astype(np.int32))
        groups = pc.binary_join(pa.ListArray.from_arrays(offsets, joined), ";")
        links, n_links = self._links(ids_a, ids_b, ends_a, ends_b, np.repeat(np.arange(len(texts)), n_a), len(texts))
        return [*(pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups, n_links)), groups, links]

    def _links(
        self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, owner: np.ndarray, count: int
    ) -> tuple[pa.Array, np.ndarray]:
        """The linked pairs of ids of each text with their number, and the number of links of each text."""
        ends = np.concatenate([ends_a, ends_b])
        ends.sort(kind="stable")
        if len(ends):
            ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        text = owner[at_a]
        width = len(self.b.sizes)
        pair = ids_a[at_a] * width + ids_b[at_b]
        base = len(self.a.sizes) * width
        key = text * base + pair
        key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(key)))
        key = key[new]
        text_of, pair = key // base, key % base
        offsets = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=count))]).astype(np.int32)
        columns = [pa.array(v.astype(np.int32)) for v in (pair // width, pair % width, times)]
        structs = pa.StructArray.from_arrays(columns, fields=[pa.field(name, pa.int32(), False) for name in LINK.names])
        kind = pa.list_(pa.field("element", structs.type, False))
        return pa.ListArray.from_arrays(pa.array(offsets), structs, type=kind), np.bincount(text, minlength=count)


_ALIGNERS: dict[int, Aligner] = {}


def align_tokens(df: DataFrame, byte_vocabulary: str, piece_model: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` and ``links``.

    ``groups`` spells the alignment: ids of A, ``|``, ids of B, groups parted by ``;``, ids by commas. ``links`` holds
    each pair of ids linked in the text, with its number of links. The two vocabulary files are read on the driver and
    broadcast; their size is fixed.
    """
    if clash := set(ADDED.fieldNames()) & set(df.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    contents = []
    for path in (byte_vocabulary, piece_model):
        with open(path, "rb") as file:
            contents.append(file.read())
    files = df.sparkSession.sparkContext.broadcast((*contents, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = hash(files.value)
        if mine not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[mine] = Aligner(*files.value)
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                new = _ALIGNERS[mine].align(part.column(text).cast(pa.large_binary()).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *ADDED.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *ADDED.fields]))


def linked_pairs(aligned: DataFrame, links: str = "links") -> DataFrame:
    """Pairs of ids ``(a, b)`` with the number of links that hold them in all texts, ``count``, and whether no pair of
    the same ``b`` has more, ``best``. Counts are summed on the map side; the table has at most one row per pair."""
    counts = written(
        aligned.select(F.inline(links)).groupBy("a", "b").agg(F.sum(F.col("times").cast("long")).alias("count")), "alignment-counts"
    )
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # one row per id of B
    return counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def weigh(aligned: DataFrame, pairs: DataFrame, key: str, links: str = "links") -> DataFrame:
    """``(key, n_best, count_sum)`` of the rows of ``aligned`` that have links; ``key`` tells its rows apart."""
    pairs = written(pairs, "alignment-pairs")
    total = pairs.agg(F.sum("count")).first()[0] or 0
    heavy = F.col("count") * F.lit(HEAVY_SHARE) >= F.lit(total)
    single = aligned.select(F.col(key), F.inline(links))
    # The row number of a table that was written tells rows apart, so sums of a row begin in the task that reads it.
    best, counted = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("times") * F.col("count"))
    sums = [best.alias("n_best"), counted.alias("count_sum")]
    often = F.broadcast(pairs.filter(heavy))
    common = single.join(often, ["a", "b"]).groupBy(key).agg(*sums)
    rare = single.join(often, ["a", "b"], "left_anti").join(pairs.filter(~heavy), ["a", "b"]).groupBy(key).agg(*sums)
    return common.union(rare).groupBy(key).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def numbered(aligned: DataFrame, *columns: str | Column) -> DataFrame:
    """These columns and the links of ``aligned``, written, with ``row`` as a number of their own for its rows."""
    return written(aligned.select(F.monotonically_increasing_id().alias("row"), *columns, "links"), "alignment-links")
