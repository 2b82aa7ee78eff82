"""Jaccard join, line dedup and suffix dedup against brute force."""

import random
import time

import numpy as np
import pytest
from llm.helpers import ODD, documents, edited, prose, words
from pyspark.sql import functions as F

from telemetry_lake.llm import jaccard, lines, suffixes
from telemetry_lake.llm.common import components


def corpus():
    base = [prose(i, n) for i, n in enumerate([5, 12, 40, 80, 120, 200])]
    passage = prose(99, 60)
    rows = [(i, t) for i, t in enumerate(ODD)]
    for k, text in enumerate(base):
        rows += [(100 + 20 * k + j, edited(text, 7 * k + j, 0.002 * j)) for j in range(12)]
        rows += [(400 + k, text), (500 + k, text), (600 + k, passage + " " + prose(200 + k, 30) + "\n" + text)]
    rows += [(700 + i, passage + " " + prose(300 + i, 6)) for i in range(30)]
    rows += [(None, base[3]), (None, None), (100, edited(base[0], 100, 0)), (450, passage)]
    random.Random(5).shuffle(rows)
    return rows


def shingle_set(text, size):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_components(rows, size, percent):
    rows = [(i, shingle_set(t, size)) for i, t in rows if i is not None]
    label = {i: i for i, _ in rows}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, a in rows:
        for y, b in rows:
            if x < y and a and b and 100 * len(a & b) >= percent * len(a | b) and find(x) != find(y):
                low, high = sorted((find(x), find(y)))
                label[high] = low
    return {i: find(i) for i, _ in rows}


def brute_links(rows, size, percent):
    """Numbers of links by (id, text); rows of one id are one document."""
    sets = [(i, t, shingle_set(t, size)) for i, t in rows]
    out = {}
    for x, (i, t, a) in enumerate(sets):
        equal = sum(y != x and a == b for y, (_, _, b) in enumerate(sets)) if a else 0
        others = sum(bool(b) and a != b and j is not None and i is not None and 100 * len(a & b) >= percent * len(a | b) for j, _, b in sets) if a else 0
        out.setdefault((i, t), []).append(equal + others)
    return {name: counts[0] for name, counts in out.items()}


@pytest.mark.parametrize("size,percent,chunk,broadcast", [(4, 85, 400_000, 10**6), (5, 80, 300, 0), (1, 50, 40, 10**6)])
def test_jaccard_components(spark, monkeypatch, size, percent, chunk, broadcast):
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", chunk)
    monkeypatch.setattr("telemetry_lake.llm.common.BROADCAST_ROWS", broadcast)
    rows = corpus()
    got = jaccard.join_similar(documents(spark, rows), size, percent).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows, size, percent)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    sizes = sorted(((i is None, i or 0, len(shingle_set(t, size))) for i, t in rows))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sizes
    ids = [i for i, _ in rows]
    links = {i: n for (i, _), n in brute_links(rows, size, percent).items() if i is not None and ids.count(i) == 1}
    assert {r.doc_id: r.n_links for r in got if r.doc_id in links} == links and max(links.values()) > 5


@pytest.mark.parametrize("share", [1.0, 0.5, 0.04])
def test_blocks_of_a_list_are_bounded_and_join_all_who_chose(spark, monkeypatch, share):
    # Two lists of 400 classes of 20 shingles, joined by one class; a share of each list chose its shingle.
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 1_000)
    rnd = random.Random(4)
    rows = [(token, 400 * token + i, 20, i == 0 or rnd.random() < share) for token in (0, 1) for i in range(400)]
    rows.append((1, 0, 20, True))
    lists = spark.createDataFrame(rows, "token bigint, rep bigint, n bigint, chosen boolean")
    inside = {}
    for r in jaccard.blocks_of(lists).collect():
        inside.setdefault(r.block, []).append(r.rep)
    assert all(len(v) == len(set(v)) for v in inside.values())
    assert all(b.startswith("t/") for b in inside) and max(map(len, inside.values())) * 20 <= 3_000
    met = {(a, b) for v in inside.values() for a in v for b in v}
    for token in (0, 1):
        own = [(rep, chosen) for t, rep, _, chosen in rows if t == token]
        assert all((a, b) in met for a, chosen in own if chosen for b, _ in own)


@pytest.mark.parametrize("heap", [0, 10**6])
def test_divide_skip_finds_every_link(monkeypatch, heap):
    monkeypatch.setattr(jaccard, "HEAP_ENTRIES", heap)
    rnd = random.Random(3)
    sets = [np.unique(np.array([rnd.randrange(60) for _ in range(rnd.randrange(5, 40))], np.uint64)) for _ in range(60)]
    similar = {(a, b) for a in range(60) for b in range(60) if a != b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b]))}
    for cost in (0.01, 1.0):
        monkeypatch.setattr(jaccard, "MERGE_COST", cost)
        block = jaccard.Block(list(range(60)), sets, 60)
        found = {(int(block.ids[a]), int(block.ids[b])) for a, b in block.pairs()}
        assert found | {(b, a) for a, b in found} == similar and 2 * len(found) == len(similar)
        weights = np.arange(60) + 1
        block = jaccard.Block(list(range(60)), sets, 60, weights)
        label = list(range(60))
        for a, b in block.run():
            assert (a, b) in similar
            label = [label[b] if v == label[a] else v for v in label]
        assert all(label[a] == label[b] for a, b in similar)
        assert dict(zip(block.ids.tolist(), block.n_links.tolist(), strict=True)) == {a: sum(int(weights[y]) for x, y in similar if x == a) for a in range(60)}


def test_clusters_of_near_copies_in_one_block():
    """Two clusters of 2,000 near copies: all links of a set are found in a few array steps."""
    rnd = np.random.default_rng(1)
    sets = [np.unique(np.concatenate([np.arange(40) + 1_000 * (k % 2), rnd.integers(10**6, 10**9, 1)])).astype(np.uint64) for k in range(4_000)]
    block, began = jaccard.Block(list(range(4_000)), sets, 85), time.time()
    assert len(list(block.run())) == 3_998 and set(block.n_links.tolist()) == {1_999}
    assert time.time() - began < 20


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(100, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 1000: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_lines(rows, percent=80):
    flat = []
    for i, t in rows:
        if t is not None:
            for p, line in enumerate(t.split("\n")):
                s = frozenset(w.lower() for w in words(line))
                flat.append(((i is None, i or 0, p), i, t, p, s))
    gone = set()
    for at, i, t, p, s in flat:
        if s and any(o < at and 100 * len(s & z) >= percent * len(s | z) for o, _, _, _, z in flat):
            gone.add((i, t, p))
    return {(i, t): "\n".join(x for p, x in enumerate(t.split("\n")) if (i, t, p) not in gone) for i, t in rows if t is not None}


@pytest.mark.parametrize("broadcast,percent", [(10**6, 80), (0, 80), (0, 60), (10**6, 100)])
def test_line_dedup(spark, monkeypatch, broadcast, percent):
    monkeypatch.setattr("telemetry_lake.llm.common.BROADCAST_ROWS", broadcast)
    rnd = random.Random(8)
    pool = [prose(i, rnd.randrange(3, 30), 60) for i in range(40)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(60):
        own = [edited(rnd.choice(pool), i, rnd.choice([0, 0, 0.05, 0.1, 0.4])) for _ in range(rnd.randrange(1, 6))]
        rows.append((1000 - i, "\n".join([*own, "", "Short one."])))
    rows += [(None, pool[3]), rows[-1], (3, pool[5] + "\n" + pool[5].upper())]
    rows += [(2000 + i, "\n".join(" ".join(rnd.sample("abcde", rnd.randrange(1, 6))) for _ in range(3))) for i in range(20)]
    monkeypatch.setattr(lines, "GROUP_ROWS", 10**6 if broadcast else 4)
    monkeypatch.setattr(lines, "FEW_WORDS", 64 if broadcast else 12)
    df = documents(spark, rows).withColumn("gone", F.lit("mine")).withColumn("w", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("at", F.lit(3))
    got = lines.dedupe_lines(df, percent).collect()
    assert len(got) == len(rows) and all((r.gone, r.w, r._id, r.at) == ("mine", 1, 2, 3) for r in got)
    expected = sorted(((i is None, i or 0), t or "") for (i, _), t in brute_lines(rows, percent).items() for _ in range(rows.count((i, _))))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in got if r.text is not None) == expected


def test_a_hot_word_and_many_versions_of_a_line(spark):
    """A word that every line has, and a line of which most texts have a version of their own."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(["hot", *(w if rnd.random() > 0.02 else f"x{i}" for w in base)])) for i in range(150)]
    rows += [(200 + i, " ".join(["hot", *prose(i, rnd.randrange(1, 9), 12).split()])) for i in range(150)]
    got = {r.doc_id: r.text for r in lines.dedupe_lines(documents(spark, rows)).collect()}
    assert got == {i: t for (i, _), t in brute_lines(rows).items()}
    with pytest.raises(ValueError):
        lines.dedupe_lines(documents(spark, []).withColumn("_lines", F.lit(1)))


def test_short_lines_need_words_to_differ_by_one():
    assert [lines.least_words(p) for p in (50, 60, 80, 85, 90)] == [1, 2, 4, 6, 9]
    for percent in (50, 60, 80, 85, 90):
        n = lines.least_words(percent)
        assert 100 * n >= percent * (n + 1) and 100 * (n - 1) < percent * n


def brute_cut(rows, length):
    seen = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for p in range(len(raw) - length + 1):
                s = raw[p : p + length]
                seen[s] = min(seen.get(s, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        dead = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if i is not None and seen[raw[p : p + length]] < i:
                dead[p : p + length] = b"\1" * length
        kept = bytes(b for b, d in zip(raw, dead, strict=True) if not d)
        out.append(((i is None, i or 0), len(raw), len(raw) - len(kept), sum(d and not (p and dead[p - 1]) for p, d in enumerate(dead)), kept))
    return sorted(out)


@pytest.mark.parametrize("length,collection,broadcast", [(50, 16_384, 10**6), (20, 64, 0)])
def test_suffix_dedup(spark, monkeypatch, length, collection, broadcast):
    monkeypatch.setattr(suffixes, "COLLECTION", collection)
    monkeypatch.setattr("telemetry_lake.llm.common.BROADCAST_ROWS", broadcast)
    rows = [(i, t) for i, t in corpus() if not t or len(t) < 5_000] + [(800 + i, "ab" * n) for i, n in enumerate([10, 30, 60, 200])]
    got = suffixes.remove_repeats(documents(spark, rows).withColumn("starts", F.lit(0)), length).collect()
    found = sorted(
        ((r.doc_id is None, r.doc_id or 0), r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got
    )
    assert found == brute_cut(rows, length)


def test_anchors_shared_by_chance_are_not_sorted(spark):
    """Texts that share 24 bytes may have an anchor in common, but no string of 50 bytes; those that share 50 do."""
    def rows(shared):
        return [(i, f"{i}" + prose(20 * i, 30) + " " + prose(1, 40)[:shared] + prose(20 * i + 1, 30) + f"{i}") for i in range(12)]

    def kept(shared):
        search = suffixes._keyed(documents(spark, rows(shared)), "text", "doc_id")
        return {r.id for r in suffixes._shared_anchors(search, 50).collect()}

    assert kept(24) == set() and kept(50) == kept(200) == set(range(12))
    for shared in (50, 51, 67, 200):
        found = sorted(((False, r.doc_id), r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in suffixes.remove_repeats(documents(spark, rows(shared))).collect())
        assert found == brute_cut(rows(shared), 50) and found[1][2] >= shared


def test_sides_of_an_anchor_cover_every_string():
    for length in (17, 18, 20, 50, 51, 110):
        for count in (suffixes.ROUGH_SIDES, suffixes.SIDES):
            for before in range(length - suffixes.GRAM + 1):
                after = length - suffixes.GRAM - before
                assert any(a <= before and b <= after for a, b in suffixes.sides(length, count))


def test_collection_is_a_suffix_array():
    rnd = random.Random(1)
    strings = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randrange(0, 30))) for _ in range(40)]
    found = suffixes.Collection(strings)
    suffix = [strings[s][len(strings[s]) - t :] for s, t in zip(found.string.tolist(), found.taken.tolist(), strict=True)]
    assert suffix == sorted(suffix) and len(suffix) == sum(len(s) + 1 for s in strings)
    for a, b, n in zip(suffix, suffix[1:], found.common[1:].tolist(), strict=False):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    front = [strings[s][len(strings[s]) - t - 1] + 1 if t < len(strings[s]) else 0 for s, t in zip(found.string.tolist(), found.taken.tolist(), strict=True)]
    assert front == found.front.tolist()


def test_empty_tables(spark):
    none = documents(spark, [])
    assert jaccard.join_similar(none).count() == 0
    assert lines.dedupe_lines(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0


def test_shingles_of_leads_are_counted_in_parts(spark, monkeypatch):
    parts, kept = [], jaccard._kept
    monkeypatch.setattr(jaccard, "_kept", lambda rows, purpose: parts.append(kept(rows, purpose)) or parts[-1])
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(i, " ".join(words[: 110 + i])) for i in range(10)], "doc_id bigint, text string")
    found = jaccard.join_similar(docs, 4, 85).collect()
    assert [(r.component_id, r.n_links) for r in found] == [(0, 9)] * 10
    tokens = [{r.token for r in part.select("token").distinct().collect()} for part in parts]
    assert len(tokens) == jaccard.TOKEN_PARTS and sum(bool(own) for own in tokens) > 1
    assert all({token % jaccard.TOKEN_PARTS for token in own} <= {i} for i, own in enumerate(tokens))


def test_lists_are_ranked_where_their_shingles_are_counted(spark, monkeypatch):
    """The second pass leaves no table behind but the lists: its rows of a document are ranked without another exchange."""
    purposes, write = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda rows, purpose: purposes.append(purpose) or write(rows, purpose))
    rows = corpus()
    found = jaccard.join_similar(documents(spark, rows), 4, 85).select("doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == brute_components(rows, 4, 85)
    assert purposes.count("jaccard-shared") == purposes.count("jaccard-lists") == 1


def test_pairs_of_a_settled_line_are_not_verified(spark, monkeypatch):
    """Of 60 similar lines one pair each is verified; all pairs of a line only if its nearest one is not similar."""
    seen, verified = [], lines._verified
    monkeypatch.setattr(lines, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(60)] + [(60, prose(7, 41)), (61, " ".join([*base, "y"]))]
    frame = documents(spark, rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("sum"), "text")
    ats = {r.id: r.at for r in frame.select("id", lines._at(F.lit(0).cast("long"), F.col("sum")).alias("at")).collect()}
    pairs = [(i, ats[i], j, ats[j], 2) for i in range(60) for j in range(i)] + [(61, ats[61], 60, ats[60], 0), (61, ats[61], 5, ats[5], 2)]
    given = spark.createDataFrame(pairs, "id bigint, at bigint, eid bigint, eat bigint, flips int")
    found = {r.id for r in lines._similar(given, frame, 80, "line-test").collect()}
    assert found == {*range(1, 60), 61} and seen == [60, 2]


def test_words_of_a_line_are_hashed_once(spark):
    levels = F.array_repeat(F.lit(1).cast("bigint"), lines.RARITY_BUCKETS)
    text = "A b\tc\x0bA  Σας \x0c\rb\na É"
    plain = documents(spark, [(1, text)]).select(lines._plain("text").alias("text"))
    assert plain.first().text == "a b c a  σας   b\na é"
    ranked = plain.select(lines._ranked("text", levels).alias("ranked"))
    assert len(ranked.first().ranked) == len({"a", "b", "c", "σας", "b\na", "é"})
    assert ranked._jdf.queryExecution().analyzed().toString().count("xxhash64(") == 1


def test_whole_sets_are_shuffled_to_their_blocks_alone(spark, monkeypatch):
    """Sets of ids that do not repeat are written without an exchange, and are not dealt by id to meet their blocks."""
    plans, write = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda rows, purpose: plans.update({purpose: rows._jdf.queryExecution().optimizedPlan().toString()}) or write(rows, purpose))
    rows = corpus()
    found = jaccard.join_similar(documents(spark, rows), 4, 85).select("doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == brute_components(rows, 4, 85)
    once, again = plans["jaccard-full"].split("Aggregate [rep", 1)
    assert "LeftAnti" in once and "LeftSemi" in again
    assert "strategy=broadcast" in plans["jaccard-links"]
