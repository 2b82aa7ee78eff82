"""Toxicity, language, quality rules, encoding and decontamination."""

import base64
import collections
import hashlib
import math
import random
import re
import tracemalloc
import unicodedata

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from conftest import SMALL
from llm.helpers import BLANK, ODD, documents, prose
from pyspark.sql import functions as F

from telemetry_lake.llm import bpe, decontaminate, language, quality, toxicity
from telemetry_lake.llm.grams import hashed, pieces
from telemetry_lake.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count=300):
    rnd = random.Random(4)
    alphabets = [list("ab  \t\n'sdvl1.,é\x1c\x85\xa0²½ªñ 中́Ⅷ"), list("abc  \n'srelt09!?éüß"), list("aab"), [chr(i) for i in range(300)]]
    return ["".join(rnd.choice(a) for _ in range(rnd.randrange(200))) for a in alphabets for _ in range(count // 4)]


def test_encoding_equals_the_library(reference, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 120)
    encoder = bpe.Encoder(bpe.parse_ranks(open(PATH, "rb").read()), public_tokenizers.PATTERN)
    texts = [t or "" for t in ODD] + random_texts() + ["ab" * 3_000, "the" * 400]
    for size in (1 << 18, 8):
        monkeypatch.setattr(bpe, "CACHE_SIZE", size)
        for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
            assert ids == reference.encode_ordinary(text)
            assert encoder.decode(ids) == text.encode()


def test_rank_queue_pops_the_lowest_rank_leftmost():
    queue, rnd = bpe.RankQueue(5_000), random.Random(2)
    entries = [(rnd.randrange(5_000), i) for i in range(800)]
    for rank, position in entries:
        queue.push(rank, position)
    assert [queue.pop() for _ in entries] == sorted(entries) and not queue.bits.upper


def test_encoding_of_a_table(spark, reference):
    df = documents(spark, [(i, t) for i, t in enumerate(ODD)] + [(0, None)]).withColumn("n_tokens", F.lit("mine"))
    rows = bpe.encode_decode(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 1 and rows[0].n_tokens == "mine"
    for row in rows:
        assert row.ids == reference.encode_ordinary(row.text or "") and bytes(row.decoded) == (row.text or "").encode()
    with pytest.raises(ValueError):
        bpe.encode_decode(df.withColumn("ids", F.lit(1)), PATH, public_tokenizers.PATTERN)
    assert bpe.encode_decode(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_encoding_query(spark, reference):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    for row in QUERIES["op7_byte_bpe"](spark, SMALL).collect():
        ids = reference.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(text, items):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, names = set(), set()
    for name, item in items:
        v = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        for k in range(max(1, len(v) - 9) if v else 0):
            window = v[k : k + 10]
            for p in range(len(w) - len(window) + 1):
                if w[p : p + len(window)] == window:
                    names.add(str(name))
                    hit.update(range(p, p + len(window)))
    return len(w), hit, sorted(names)


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(i, prose(i, n, 50)) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 30, 60])]
    items += [(20, None), (21, "!!"), (22, "a"), (23, items[7][1]), (24, "É ü"), (25, "Zwölf " * 12)]
    rnd = random.Random(1)
    texts = list(ODD[:8]) + [prose(100 + i, 400, 50) for i in range(10)] + ["é ü zwölf", "É ü!", "zwölf, " * 30]
    for i in range(30):
        own = rnd.choice(items[5:9])[1].split()
        a = rnd.randrange(len(own))
        texts.append(prose(500 + i, 20, 9999) + " " + ". ".join(own[a : a + rnd.randrange(1, 40)]).upper() + "\n" + prose(600 + i, 9, 9999))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    df = documents(spark, [(i, t) for i, t in enumerate(texts)]).withColumn("item_id", F.lit(1))
    got = decontaminate.find_contamination(df, benchmark).collect()
    assert len(got) == len(texts)
    for row in got:
        n, hit, names = brute_hits(row.text, items)
        spans = {k for s in row.spans for k in range(s.first_word, s.last_word + 1)}
        assert (row.n_words, row.n_hit, spans, row.item_ids) == (n, len(hit), hit, names)
    assert decontaminate.find_contamination(df, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(documents(spark, []), benchmark).count() == 0


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_benchmark_items_without_an_id_are_hit(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    passages = [prose(i, 12) for i in range(3)]
    benchmark = spark.createDataFrame([(None, passages[0]), (None, passages[1]), (7, passages[1]), (8, passages[2]), (None, None)], "item_id bigint, text string")
    rows = [(i, f"{prose(10 + i, 9)} {t} {prose(20 + i, 9)}") for i, t in enumerate([*passages, ""])]
    got = {r.doc_id: r for r in decontaminate.find_contamination(documents(spark, rows), benchmark).collect()}
    assert [(got[i].n_hit, got[i].item_ids) for i in range(4)] == [(12, []), (12, ["7"]), (12, ["8"]), (0, [])]


def brute_counts(text):
    w = re.findall(BLANK, text or "")
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    own = [x for x in (text or "").split("\n") if re.search(BLANK, x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(own) - len(set(own)), len(covered)


def bucket(*parts):
    """Spark's xxhash64 of strings: each hash is the seed of the next."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed % 2**64 - (2**64 if seed >= 2**63 else 0)


def test_quality_rules(spark):
    texts = [t for t in ODD if not t or len(t) < 50_000] + [prose(i, 60, 300) for i in range(20)]
    texts += [" ".join(f"{w}{random.Random(i).choice('#$%')}" for w in prose(i, 60, 300).split()) for i in range(20)]
    texts += ["of the " * 30, prose(1, 20) + " " + prose(1, 20), "one line\none line\nother\n\n", prose(50, 60, 300), None]
    df = documents(spark, list(enumerate(texts))).withColumn("_h", F.lit("mine")).withColumn("score_", F.lit(1))
    trusted = spark.createDataFrame([(i,) for i in range(8, 28)] + [(None,), (9,)], "doc_id bigint")
    got = {r.doc_id: r for r in quality.judge(df, trusted, threshold=-0.02).collect()}
    assert len(got) == len(texts)
    raw, target = collections.Counter(), collections.Counter()
    grams = {}
    for i, t in enumerate(texts):
        w = [x.lower() for x in re.findall(BLANK, t or "")]
        grams[i] = [bucket(x) % quality.BUCKETS for x in w] + [bucket(x, y) % quality.BUCKETS for x, y in zip(w, w[1:], strict=False)]
        raw.update(grams[i])
        if 8 <= i < 28:
            target.update(grams[i])
    scale = sum(target.values()) / sum(raw.values())
    weight = {b: math.log((target[b] + quality.SMOOTHING) / (raw[b] * scale + quality.SMOOTHING)) for b in raw}
    for i, t in enumerate(texts):
        n, chars, symbols, lines, repeated = brute_counts(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        score = sum(weight[b] for b in grams[i]) / len(grams[i]) if grams[i] else 0.0
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n) and r._h == "mine"
        assert abs(r.score - score) < 1e-9 and r.kept == (not r.base_failed and score >= -0.02)
    assert sum(got[i].kept for i in range(8, 28)) == 20 and not any(got[i].kept for i in range(28, 48))
    plain = quality.judge(df, trusted.limit(0)).filter("kept = base_failed OR score <> 0")
    assert plain.count() == 0 and quality.judge(df.limit(0), trusted).count() == 0


def test_very_long_texts_are_judged_whole(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(0, long), (1, long + "\n" + long), (2, "a b c d e f g h " * 8_000)]
    trusted = spark.createDataFrame([(0,)], "doc_id bigint")
    got = {r.doc_id: r for r in quality.judge(documents(spark, rows), trusted).collect()}
    assert [(got[i].n_words, got[i].n_repeat_words, got[i].base_failed) for i in range(3)] == [(30_000, 0, False), (60_000, 60_000, True), (64_000, 64_000, True)]
    assert got[1].n_dup_lines == 1


def test_grams_stay_inside_words():
    raw = [b"", b"Ab  cd", b"x" * 300_000, "é!".encode()]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    seen = collections.Counter()
    for joined, owner in pieces(data, offsets):
        for at, found in hashed(joined, (3,), 16):
            assert not (joined[at + 1] == 32).any() and found.max() < 1 << 16
            seen.update(owner[at + 1].tolist())
    assert seen[0] == 0 and seen[1] == 4 and seen[3] == 2 and seen[2] >= 300_000 - 4


def toxic_corpus(count=400):
    rnd, rows = random.Random(6), []
    bad = ["blargh", "snorfel", "wugger"]
    for i in range(count):
        w = prose(i, rnd.choice([10, 60, 300]), 800).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(w) // 60)):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity(spark):
    rows = toxic_corpus()
    df = documents(spark, [(i, t) for i, t, _ in rows] + [(10_000 + i, t) for i, t in enumerate(ODD)]).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")
    examples = toxicity.sample(df, labels, F.col("doc_id") < 300)
    assert len(examples) == 300 and sum(y for _, y in examples) == 75
    model = toxicity.train([t for t, _ in examples], [y for _, y in examples])
    got = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(df, model).collect()}
    assert len(got) == len(rows) + len(ODD) and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 300]
    assert sum(held) >= 0.95 * len(held)
    assert all(got[10_000 + i] < 0.5 for i, t in enumerate(ODD) if not (t or "").strip())
    near = model.scores(pa.array(["w1 w2 snorfell w3 w4 w5", "w1 w2 w10 w3 w4 w5"]))
    assert near[0] > near[1]  # an unseen spelling
    assert toxicity.train([], []).scores(pa.array(["a", None])).max() < 0.01
    assert toxicity.train(["a", ""], [1, 1]).scores(pa.array(["b"])).min() > 0.99
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0
    again = documents(spark, [(1, rows[0][1]), (1, rows[0][1]), (2, rows[0][1]), (3, " ".join([rows[1][1]] * 400)), (4, rows[1][1])])
    scores = [r.toxicity for r in toxicity.score_toxicity(again, model).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] == scores[2] and (scores[3] >= 0.5) == (scores[4] >= 0.5)


def most_memory(work) -> int:
    """Most bytes that Python holds at once during ``work``, beyond those it held before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_language_fit_holds_one_language_at_a_time():
    # 1,200 whole vectors of doubles are 150 MB; a language's 100 vectors of floats are 6 MB.
    texts = [f"word{i} some more words of text {i % 7}" for i in range(1_200)]
    names = [f"lang{i % 12:02}" for i in range(1_200)]
    assert most_memory(lambda: language.fit(texts, names)) < 60 << 20


def test_bpe_memory_of_a_part():
    # Texts that are encoded together, all their pre-tokens new.
    encoder = bpe.Encoder(bpe.parse_ranks(open(PATH, "rb").read()), public_tokenizers.PATTERN)
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    size, texts = 0, []
    while size < bpe.BATCH_BYTES:
        texts.append(" ".join("".join(rng.choices(letters, k=6)) for _ in range(300)))
        size += len(texts[-1])
    assert most_memory(lambda: encoder.encode_all(texts)) < 250 << 20


def test_language(spark):
    rnd = random.Random(9)
    parts = {"aa": ["lo", "ra", "mi", "tun"], "bb": ["scht", "ung", "ver", "ein"], "cc": ["ção", "lhe", "nho", "qué"]}
    rows = []
    for i in range(300):
        lang = rnd.choice(list(parts))
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(3, 80)))
        rows.append((i, text, lang if i % 7 else None, lang))
    df = spark.createDataFrame([r[:3] for r in rows] + [(1_000 + i, t, None) for i, t in enumerate(ODD)], "doc_id bigint, text string, lang string")
    examples = language.sample(df, F.col("doc_id") < 200)
    model = language.fit([t for t, _ in examples], [y for _, y in examples])
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    held = [got[i].language == lang for i, _, _, lang in rows if i >= 200]
    assert sum(held) >= 0.98 * len(held) and all(0 <= r.cosine <= 1 for r in got.values())
    for i, t in enumerate(ODD):
        lettered = any(unicodedata.category(c)[0] == "L" for c in t or "")
        assert (got[1_000 + i].language != "und") == lettered
    numerals = documents(spark, [(0, "½ ²"), (1, "①"), (2, "Ⅷ 12"), (3, "12 a"), (4, "ª")])
    assert [r.language != "und" for r in language.identify(numerals, model).orderBy("doc_id").collect()] == [False, False, False, True, True]
    assert got[1_008].rejected  # one letter 40,000 times is near no centroid
    empty = language.fit([], [])
    assert {r.language for r in language.identify(df, empty).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def test_model_queries_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.01")
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op2_language"](spark, folder).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op1_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in toxic]
    high, low = ([r.score for r in rows if toxic[r.doc_id] == y] for y in (1, 0))
    # 45 toxic examples are few; the order of the scores has to be right nevertheless.
    assert sum((a > b) + 0.5 * (a == b) for a in high for b in low) >= 0.8 * len(high) * len(low)


def copied_corpus():
    # Labelled good and unlabelled texts of one vocabulary, junk of another, and a clean text nobody labelled.
    good = [(i, prose(i, 80, 300)) for i in range(200)]
    junk = [(1_000 + i, " ".join(f"{w}$" for w in prose(i, 80, 300).split())) for i in range(100)]
    return good, junk, " ".join(f"clean{i}" for i in range(60))


def test_quality_counts_a_text_once_however_often_it_is_copied(spark):
    good, junk, clean = copied_corpus()
    trusted = spark.createDataFrame([(i,) for i, _ in good[:150]], "doc_id bigint")
    once = documents(spark, [*good, *junk, (10_000, clean)])
    often = documents(spark, [*good, *junk, *[(10_000 + i, clean) for i in range(3_000)]])
    single = {r.doc_id: r for r in quality.judge(once, trusted).collect()}
    many = {r.doc_id: r for r in quality.judge(often, trusted).collect()}
    assert all(many[10_000 + i].kept for i in range(3_000)) and not any(many[i].kept for i, _ in junk)
    assert all(r.kept == many[i].kept and abs(r.score - many[i].score) < 1e-9 for i, r in single.items())


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_quality_verdicts_do_not_depend_on_repeats_of_the_corpus(spark, monkeypatch, broadcast):
    monkeypatch.setattr("telemetry_lake.llm.common.BROADCAST_ROWS", broadcast)
    good, junk, clean = copied_corpus()
    rows = [*good, *junk, (10_000, clean), (10_001, None), (None, "")]
    trusted = spark.createDataFrame([(i,) for i, _ in good[:150]], "doc_id bigint")
    single = {r.doc_id: r for r in quality.judge(documents(spark, rows), trusted).collect()}
    tenfold = documents(spark, [(i and i + 100_000 * k, t) for i, t in rows for k in range(10)])
    got = quality.judge(tenfold, trusted).collect()
    assert len(got) == 10 * len(rows)
    for r in got:  # copies are judged alike, and as the text is that stands alone
        own = single[r.doc_id and r.doc_id % 100_000]
        assert abs(r.score - own.score) < 1e-9 and r.kept == own.kept


def test_quality_smoothing_follows_the_target(spark, monkeypatch):
    # Four times the distinct texts of the same words: a word that no trusted text has weighs the same.
    monkeypatch.setattr(quality, "SMOOTHING", 1e-3)
    least = []
    for times in (1, 4):
        rows = [(1_000 * k + i, f"{('a b ', 'a c ')[i % 2] * 20}n{i}t{k}") for k in range(times) for i in range(100)]
        trusted = spark.createDataFrame([(i,) for i, _ in rows if i % 4 == 0], "doc_id bigint")
        least.append(min(r["_weight"] for r in quality.bucket_weights(documents(spark, rows), trusted).collect()))
    assert abs(least[0] - least[1]) < 1e-6
