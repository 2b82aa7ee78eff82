"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

1. Documents with equal sets are one class, represented by the smallest id.
2. A class puts its *lead*, the shingles of smallest hash, about twice as many as a partner may lack, into an
   inverted index. A document of n shingles and threshold t lacks at most d = floor((1 - t) n) of its own in any
   partner. So, if its lead ends before the partner's, all but d of its lead are in the partner's lead: a
   document with too few shared shingles in its lead has no partner and is done. Of the others each takes the
   d + 1 rarest shingles of its lead; a partner has one of them at least.
3. Classes that share such a shingle, directly or through others, form a group of candidates (lists of similar
   length only). A group is cut into chunks of a bounded number of shingles, and each pair of chunks is a block of its
   own; where fewer sets are sent that way, the lists take the place of the group: a block is a chunk of those that
   chose the shingle and a chunk of its list, or two chunks of the list where most chose it. Chunks are dealt by hash,
   so a block has about two chunks of shingles at most, or one set that is longer. No row holds a pair.
4. In a block each document searches the inverted index of the whole sets with DivideSkip: the longest lists are
   set aside, the short ones are merged (with a heap, or as sorted runs where they hold many entries), and documents
   that occur often enough are looked up in the long ones by binary search until the needed overlap is reached or out of
   reach. Every link between two classes is found; a pair that meets in several blocks is counted in one. Links that
   connect what was apart leave the block as pairs, and all others as numbers of links, so that many similar
   texts do not leave it as all their pairs.

All is exact: no candidate is dropped, whatever the length of a list. Hashes have 64 bits.

Defined results: NULL texts and texts without words have an empty set and are linked with nothing; equal sets
are linked; rows with the same id belong together; a NULL id has no partner but rows of an equal set. Very long texts
are sets like any other, taken whole; empty tables give empty results. Other columns of the documents are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from telemetry_lake.llm.common import components, release, sized, slices, written
from telemetry_lake.llm.shingles import sets_of

WORDS, PERCENT = 5, 80
# Bytes of text handled at a time, and shingles in a chunk of a group.
CHUNK_BYTES, CHUNK_SHINGLES = 4 << 20, 400_000
# Parts in which the shingles of all leads are counted.
TOKEN_PARTS = 4
# What merging an entry costs against a step of a binary search, and entries that are merged with a heap.
MERGE_COST, HEAP_ENTRIES = 1.0, 64
# Tiers of list lengths: each holds lists of up to four times the length.
MOST_TIERS = 32


def lacking(n, percent: int):
    """Most shingles of a set of n that a partner may lack."""
    return n * (100 - percent) // 100


def lead_length(n: int, percent: int) -> int:
    return min(n, 2 * lacking(n, percent) + 2)


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m elements: percent (n + m) / (100 + percent), rounded up."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(docs: DataFrame, size: int, percent: int, text: str = "text", key: str = "doc_id", whole: bool = False) -> DataFrame:
    """``(id, n, digest, tokens)`` per row: the tokens are the lead of the set, or all of it."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("id", docs.schema[key].dataType), T.StructField("n", T.LongType(), False),
        T.StructField("digest", T.BinaryType(), False), T.StructField("tokens", T.ArrayType(T.LongType(), False), False),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                sizes, digests, leads = [], [], []
                for tokens in sets_of(part.column("text"), size):
                    sizes.append(len(tokens))
                    digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    leads.append((tokens if whole else tokens[: lead_length(len(tokens), percent)]).view(np.int64))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(lead) for lead in leads])]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(leads) if leads else [], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                    names=["id", "n", "digest", "tokens"],
                )

    return rows.mapInArrow(run, schema)


def _kept(rows: DataFrame, purpose: str) -> DataFrame:
    """``written``, and the shuffle files of it are deleted."""
    kept = written(rows, purpose)
    release(kept.sparkSession)
    return kept


def candidate_lists(leads: DataFrame, percent: int) -> DataFrame:
    """``(token, rep, n, chosen)``: inverted lists over classes that may have a partner.

    The second pass counts only what the first one left, so that shingles shared with classes that have no
    partner count as unshared.
    """
    short = lambda n: F.floor(n * (100 - percent) / 100)
    # Length of the lead: it follows from n, so that it is not shuffled with every shingle.
    lead = F.least(F.col("n"), 2 * short(F.col("n")) + 2)
    rows = leads.select("rep", "n", F.explode("tokens").alias("token"))
    by_token, of_rep = Window.partitionBy("token"), Window.partitionBy("rep", "n")
    # The smallest partner asks for the fewest shared shingles of a lead.
    small = F.ceil(F.col("n") * percent / 100)
    least = F.least(small - short(small), short(small) + 2, lead - short(F.col("n")))
    for parts in (TOKEN_PARTS, 1):
        # Part by part of the shingles, so that not all of them lie in shuffle files at the same time.
        shared = [rows.filter(F.pmod("token", F.lit(parts)) == i).withColumn("df", F.count("*").over(by_token)).filter("df > 1") for i in range(parts)]
        if parts > 1:
            shared = [_kept(part, "jaccard-parts") for part in shared]
        rows = reduce(DataFrame.unionByName, shared)
        rows = rows.withColumn("cnt", F.count("*").over(of_rep)).filter(F.col("cnt") >= least).select("rep", "n", "token", "df", "cnt")
        if parts > 1:
            rows = written(rows, "jaccard-shared")
            release(leads.sparkSession)
    rank = F.row_number().over(of_rep.orderBy("df", "token"))
    own = short(F.col("n")) + 1 - (lead - F.col("cnt"))
    return rows.withColumn("rank", rank).select("token", "rep", "n", (F.col("rank") <= own).alias("chosen"))


class Block:
    """DivideSkip over the sets of one block.

    ``chunks`` are the chunks the sets come from and ``cross`` says that the block joins two of them, whose inner pairs
    meet elsewhere. ``places`` has for every set its groups of the tiers below the block's, in which a pair that
    shares one of them has been counted.
    """

    def __init__(
        self, ids: list[int], sets: list[np.ndarray], percent: int, weights: np.ndarray | None = None,
        chunks: np.ndarray | None = None, cross: bool = False, places: np.ndarray | None = None,
    ):
        sizes = np.array([len(s) for s in sets])
        order = np.lexsort((np.array(ids), sizes))
        pick = lambda values, missing: (missing if values is None else values)[order]
        self.percent, self.cross = percent, cross
        self.ids, self.sizes = np.array(ids)[order], sizes[order]
        self.weights = pick(weights, np.ones(len(ids), np.int64))
        self.chunks = pick(chunks, np.zeros(len(ids), np.int64))
        self.places = pick(places, np.zeros((len(ids), 0), np.int64))
        self.label = np.arange(len(ids))
        self.n_links = np.zeros(len(ids), np.int64)
        tokens = np.concatenate([sets[i] for i in order.tolist()])
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        by = np.argsort(tokens, kind="stable")  # owners stay in order within a list
        new = np.concatenate([[True], tokens[by][1:] != tokens[by][:-1]])
        self.list_of = np.empty(len(tokens), np.int64)
        self.list_of[by] = np.cumsum(new) - 1
        # Entries of all lists in one ascending array: list times number of sets, plus owner.
        self.entries = self.list_of[by] * len(ids) + owner[by]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each set with all sets in front of it, in the order of sizes, that it is linked with."""
        for q in range(1, len(self.ids)):
            low = int(np.searchsorted(self.sizes, -(-self.percent * int(self.sizes[q]) // 100)))
            if low < q and len(found := self.search(q, low)):
                if self.cross:
                    found = found[self.chunks[found] != self.chunks[q]]
                yield q, found

    def run(self) -> Iterator[tuple[int, int]]:
        """Pairs that connect what was apart; counts the links of every set on the way."""
        for q, found in self.links():
            roots, first = np.unique(self.label[found], return_index=True)
            for root, j in zip(roots.tolist(), found[first].tolist(), strict=True):
                if root != self.label[q]:
                    self.label[self.label == root] = self.label[q]
                    yield int(self.ids[q]), int(self.ids[j])
            counted = found[~self._elsewhere(q, found)]
            self.n_links[q] += self.weights[counted].sum()
            self.n_links[counted] += self.weights[q]

    def pairs(self) -> Iterator[tuple[int, int]]:
        """All links that are not counted elsewhere, as places in the block."""
        for q, found in self.links():
            for j in found[~self._elsewhere(q, found)].tolist():
                yield q, j

    def _elsewhere(self, q: int, found: np.ndarray) -> np.ndarray:
        return ((self.places[found] == self.places[q]) & (self.places[q] != 0)).any(1)

    def search(self, q: int, low: int) -> np.ndarray:
        """The sets ``low..q-1`` that share enough with set ``q``."""
        count, percent = len(self.ids), self.percent
        lists = self.list_of[self.starts[q] : self.starts[q + 1]] * count
        begin, end = np.searchsorted(self.entries, lists + low), np.searchsorted(self.entries, lists + q)
        needed_by = lambda j: -(-percent * (int(self.sizes[q]) + self.sizes[j]) // (100 + percent))
        least = int(needed_by(low))
        filled = np.flatnonzero(end > begin)
        if len(filled) < least:
            return filled[:0]
        length = (end - begin)[filled]
        order = np.argsort(length, kind="stable")
        filled, length = filled[order], length[order]
        long = min(least - 1, int(least / (MERGE_COST * log2(int(length[-1]) + 1) + 1)))
        cut = len(filled) - long
        j, occurs = self._merged(begin[filled[:cut]], length[:cut], lists[filled[:cut]])
        target = needed_by(j)
        for k in range(long):
            open_ = occurs + (long - k) >= target
            j, occurs, target = j[open_], occurs[open_], target[open_]
            if not len(j):
                return j
            wanted = lists[filled[cut + k]] + j
            at = np.minimum(np.searchsorted(self.entries, wanted), len(self.entries) - 1)
            occurs = occurs + (self.entries[at] == wanted)
        return j[occurs >= target]

    def _merged(self, begin: np.ndarray, length: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners in these lists, ascending, and in how many of them each occurs."""
        total = int(length.sum())
        if total <= HEAP_ENTRIES:
            runs = [(self.entries[a : a + n] - of).tolist() for a, n, of in zip(begin.tolist(), length.tolist(), lists.tolist(), strict=True)]
            owners = np.fromiter(heapq.merge(*runs), np.int64, total)
        else:
            at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(total)
            owners = np.sort(self.entries[at] - np.repeat(lists, length), kind="stable")
        new = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])) if total else np.zeros(0, np.int64)
        return owners[new], np.diff(np.append(new, total))


def class_links(sets: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """``(a, b, n)``: links between classes that connect all that is connected, and in rows without a ``b`` numbers of
    links of classes to other documents.

    ``sets`` has ``(rep, tokens, weight)``, ``blocks`` the blocks of each ``rep`` (see ``blocks_of``). Blocks of lists
    give every link as a pair instead of a number, since the lists of two classes may meet more than once.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("rep").to_pylist()
        out: list[tuple[int, int | None, int | None]] = []
        if len(ids) > 1:
            sets = [np.asarray(v.values, np.int64).view(np.uint64) for c in table.column("tokens").chunks for v in c]
            places = table.column("places").to_pylist()
            tier = table.column("tier")[0].as_py()
            wide = np.zeros((len(ids), MOST_TIERS if tier is None else tier), np.int64)
            for i, own in enumerate(places):
                for place in own or ():
                    if place["tier"] < wide.shape[1]:
                        wide[i, place["tier"]] = place["component"]
            weights, chunks = (table.column(name).to_numpy() for name in ("weight", "mine"))
            block = Block(ids, sets, percent, weights, chunks, bool(table.column("crossing")[0].as_py()), wide)
            if tier is None:
                out = [(int(block.ids[q]), int(block.ids[j]), 1) for q, j in block.pairs()]
            else:
                out = [(a, b, None) for a, b in block.run()]
                out += [(int(block.ids[i]), None, int(block.n_links[i])) for i in np.flatnonzero(block.n_links).tolist()]
        a, b, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    # The blocks are narrow and the sets are not: while the former are few, each set is shuffled to its blocks alone.
    blocks = sized(blocks, F.lit(8) + 2 * F.coalesce(F.size("places"), F.lit(0)))
    return sets.join(blocks, "rep").groupBy("block").applyInArrow(run, "a bigint, b bigint, n bigint")


def blocks_of(lists: DataFrame) -> DataFrame:
    """``(rep, block, mine, crossing, tier, places)``: the blocks in which each class meets all its candidates.

    ``mine`` is the chunk of the class, ``crossing`` says that the block joins two chunks of a group. ``places`` are the
    groups of the class by tier, as far as these are sent whole; blocks of lists have no ``tier``.

    Lists with the same members count once. Lists are grouped with those of similar length only, so that passages
    that many documents share do not chain the groups of the others together. A group is sent as a whole or,
    where fewer sets are sent that way, as its lists one by one.
    """
    sums = lists.groupBy("token").agg(
        F.max("chosen").alias("any"), F.min("rep").alias("leader"), F.count("*").alias("k"), F.sum("n").alias("weight"),
        F.bit_xor(F.xxhash64("rep")).alias("members"),
    )
    same = sums.filter("any AND k > 1").withColumn("unit", F.min("token").over(Window.partitionBy("members", "k", "leader", "weight")))
    same = same.select("token", "unit", "leader", "weight", F.floor(F.log2("k") / 2).alias("tier"))
    members = lists.join(same, "token").groupBy("unit", "rep", "n", "leader", "weight", "tier").agg(F.max("chosen").alias("chosen"))
    members = members.withColumnRenamed("unit", "token").withColumn("node", F.xxhash64("rep", "tier"))
    members = written(members, "jaccard-members")
    groups = components(members.select(F.col("node").alias("a"), F.xxhash64("leader", "tier").alias("b")), "jaccard-groups")
    chunks = lambda weight: F.ceil(F.col(weight) / CHUNK_SHINGLES)
    classes = members.select("node", "rep", "n", "tier").distinct().join(groups, "node")
    size = classes.groupBy("component").agg(F.sum("n").alias("total"))
    # Of a list of several chunks, those that chose its shingle are cut into chunks of their own.
    asking = members.filter("chosen").filter(F.col("weight") > CHUNK_SHINGLES).groupBy("token").agg(F.sum("n").alias("asked"))
    asking = sized(written(asking.withColumnRenamed("token", "_token"), "jaccard-asking"))
    members = members.join(asking, F.col("token") == F.col("_token"), "left")
    members = members.withColumn("c", chunks("weight")).withColumn("k", F.coalesce(chunks("asked"), F.lit(1)))
    most = 2 * F.col("k") > F.col("c")
    sent = F.when(most, F.col("c")).when(F.col("chosen"), F.col("c") + F.col("k") - 1).otherwise(F.col("k"))
    listed = members.join(groups, "node").groupBy("component").agg(F.sum(F.col("n") * sent).alias("listed"))
    plan = size.join(listed, "component").select(
        "component", "total", (F.col("listed") < F.col("total") * chunks("total")).alias("by_list")
    )
    placed = written(classes.join(plan, "component"), "jaccard-placed")
    # Of a group each class meets all others: a block per pair of chunks.
    sent_whole = placed.filter("NOT by_list")
    places = sent_whole.groupBy("rep").agg(F.collect_list(F.struct("tier", "component")).alias("places"))
    whole = sent_whole.select("rep", "component", "tier", chunks("total").alias("c"))
    whole = whole.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("c")))
    whole = whole.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    name = lambda *parts: F.concat_ws("/", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    block = name(F.lit("g"), "component", F.least("mine", "other").cast("string"), F.greatest("mine", "other").cast("string"))
    whole = whole.select("rep", block.alias("block"), "mine", (F.col("mine") != F.col("other")).alias("crossing"), F.col("tier").cast("int").alias("tier"))
    # Of a list only the classes that chose its shingle have to meet the others: a block per pair of a chunk of these
    # and a chunk of the list. Where most of a list chose, it is cut like a group.
    single = placed.filter("by_list").select("node").join(members, "node")
    single = single.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("c"))).withColumn("asks", F.pmod(F.xxhash64("rep"), F.col("k")))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    place = lambda i, j: F.concat_ws("/", i.cast("string"), j.cast("string"))
    met = F.transform(upto("k"), lambda i: place(i, F.col("mine")))
    meets = F.transform(upto("c"), lambda j: place(F.col("asks"), j))
    paired = F.transform(upto("c"), lambda j: place(F.least("mine", j), F.greatest("mine", j)))
    stands = F.when(most, paired).when(F.col("chosen"), F.array_union(met, meets)).otherwise(met)
    single = single.withColumn("place", F.explode(stands)).select(
        "rep", name(F.lit("t"), "token", "place").alias("block"), "mine", F.lit(False).alias("crossing"), F.lit(None).cast("int").alias("tier")
    )
    return whole.union(single).join(places, "rep", "left")


def _classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rep, n, tokens)`` of each distinct set, and ``(digest, n, rep, weight)`` of those that several rows have.

    Copies are found by their digests, which are combined before the shuffle; the sets of others stay where they are.
    """
    rows = sets.filter("n > 0 AND id IS NOT NULL")
    copies = rows.groupBy("digest", "n").agg(F.min("id").alias("rep"), F.count("*").alias("weight")).filter("weight > 1")
    copies = written(copies, "jaccard-copies")
    known = sized(copies.select("digest", "n", "rep"))
    single = rows.join(known, ["digest", "n"], "left").select(F.coalesce("rep", "id").alias("rep"), "id", "n", "digest", "tokens", F.col("rep").isNull().alias("alone"))
    several = single.filter("NOT alone AND id = rep").dropDuplicates(["digest", "n"])
    return single.filter("alone").unionByName(several).select("rep", "n", "tokens"), copies


def join_similar(
    docs: DataFrame, size: int = WORDS, percent: int = PERCENT, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``(key, n_shingles, component_id, n_links)`` for each row: size of its set, the smallest id linked to it, and
    the number of other rows it is linked with directly, copies and near copies alike."""
    sets = written(shingle_sets(docs, size, percent, text, key), "jaccard-sets")
    leads, copies = _classes(sets)
    lists = written(candidate_lists(leads, percent), "jaccard-lists")
    release(docs.sparkSession)
    blocks = written(blocks_of(lists), "jaccard-blocks")
    release(docs.sparkSession)
    asked = sized(written(blocks.select("rep").distinct(), "jaccard-asked"))
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("_text")).join(asked, "rep")
    # Only rows of an id that repeats may be equal: the sets of all others are not shuffled to find out.
    repeated = sets.select(F.col("id").alias("rep")).join(asked, "rep").groupBy("rep").count().filter("count > 1").select("rep")
    repeated = sized(written(repeated, "jaccard-repeated"))
    many = sized(copies.select("digest", "n", "weight"))

    def whole(texts: DataFrame) -> DataFrame:
        full = shingle_sets(texts, size, percent, "_text", "rep", whole=True).filter("n > 0").withColumnRenamed("id", "rep")
        return full.join(many, ["digest", "n"], "left").select("rep", "tokens", F.coalesce("weight", F.lit(1)).alias("weight"))

    again = whole(texts.join(repeated, "rep", "left_semi")).dropDuplicates(["rep", "tokens"])
    full = written(whole(texts.join(repeated, "rep", "left_anti")).unionByName(again), "jaccard-full")
    release(docs.sparkSession)
    found = written(class_links(full, blocks, percent), "jaccard-links")
    release(docs.sparkSession)
    labels = components(found.filter("b IS NOT NULL").select("a", "b"), "jaccard-components")
    # Links of blocks of lists come as pairs, some more than once.
    pairs = found.filter("b IS NOT NULL AND n IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = pairs.union(pairs.select("b", "a")).join(full.select(F.col("rep").alias("b"), "weight"), "b").select("a", F.col("weight").alias("n"))
    numbers = found.filter("b IS NULL").select("a", "n").union(ends).groupBy("a").agg(F.sum("n").alias("to_others"))
    # Classes of more than one row, or linked with another one; all other rows stand for themselves.
    every = sets.filter("n > 0").groupBy("digest", "n").agg(F.min("id").alias("rep"), F.count("*").alias("rows"))
    classes = every.join(labels, every["rep"] == labels["node"], "left").join(numbers, every["rep"] == numbers["a"], "left")
    classes = classes.filter("rows > 1 OR component IS NOT NULL").select(
        "digest", "n", F.coalesce("component", "rep").alias("component"), F.coalesce("to_others", F.lit(0)).alias("to_others"), "rows"
    )
    named = sets.select("id", "n", "digest").join(classes, ["digest", "n"], "left")
    others = F.when(F.col("id").isNotNull(), F.col("to_others")).otherwise(0)
    return named.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(others + F.col("rows") - 1, F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of similar documents: that of the smallest id, a NULL id being the largest.

    Rows are told apart by id and checksum of the text: two texts under one id are two documents, and so are texts
    without an id. Of rows equal in both, the smallest by its other columns stays. Rows without words all stay.
    """
    row, own = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("id"), F.xxhash64(text).alias("sum")), F.col("_own")
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_text"), row.alias("_name"))
    names = written(packed.groupBy("_name").agg(F.count("*").alias("rows")), "jaccard-names")
    # Documents without an id of their own get a number that no other one has.
    shared = names.groupBy("_name.id").agg(F.count("*").alias("texts")).filter("id IS NULL OR texts > 1").select("id")
    odd = names.select("_name").join(sized(written(shared, "jaccard-shared-ids")), F.col("_name.id").eqNullSafe(F.col("id")), "left_semi")
    bounds = docs.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, high = bounds.low or 0, bounds.high or 0
    number = F.lit(high) + 1 + F.monotonically_increasing_id() if high < 1 << 62 else F.lit(low) - 1 - F.monotonically_increasing_id()
    odd = sized(written(odd.select(F.col("_name").alias("_odd"), number.alias("_number")), "jaccard-numbers"))
    known = packed.join(odd, F.col("_name") == F.col("_odd"), "left").withColumn("_own", F.coalesce("_number", "_key"))
    found = join_similar(known.select(own.alias("doc_id"), "_text"), size, percent, "_text", "doc_id")
    found = written(found.filter("n_shingles > 0").select("doc_id", "component_id").distinct(), "jaccard-groups")
    labels = known.select("_own", "_name").distinct().join(found, own == F.col("doc_id")).select("_own", "_name", "component_id")
    first = labels.groupBy("component_id").agg(F.min(F.struct("_name", "_own")).alias("first")).select(F.col("first._own").alias("_kept"))
    gone = found.join(first, F.col("doc_id") == F.col("_kept"), "left_anti").select(F.col("doc_id").alias("_gone"))
    left = known.join(sized(written(gone, "jaccard-gone")), own == F.col("_gone"), "left_anti")
    many = names.filter("rows > 1").select(F.col("_name").alias("_many"))
    left = left.join(sized(written(many, "jaccard-many")), F.col("_name") == F.col("_many"), "left")
    worded = F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    again = F.col("_many").isNotNull() & F.coalesce(worded, F.lit(False))
    once = left.filter(again).groupBy("_own").agg(F.min("_row").alias("_row")).select("_row.*")
    return left.filter(~again).select("_row.*").unionByName(once)
