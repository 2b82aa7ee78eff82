"""Periodic runs, license notices and token alignment, against brute force."""

import collections
import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from llm.helpers import ODD, documents, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemetry_lake.llm import alignment, licenses, periods
from telemetry_lake.llm.span_queries import BYTE_VOCABULARY, ORACLES, PIECE_MODEL, QUERIES, license_sql

ALPHABETS = [list("ab  \t\n'sdvl1.,é\x1c\x85\xa0²½ªñ 中́Ⅷ"), [chr(i) for i in range(1, 400)], list("the and of\n  "), list("z"), list("zé")]


def random_texts(count, seed=1, longest=300):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(a) for _ in range(rnd.randrange(longest))) for a in ALPHABETS for _ in range(count)]


def brute_runs(words):
    runs = []
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            stretch = words[start : start + length]
            smallest = not any(stretch[p:] == stretch[:-p] for p in range(1, q))
            if length >= max(6, 4 * q) and smallest:
                runs.append((start, length, q))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def brute_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(word for i, word in enumerate(words) if i not in gone)


def periodic_texts(count, seed=5):
    rnd = random.Random(seed)
    for _ in range(count):
        letters, words = "abcdefghijklmnopqrstuvwxyz"[: rnd.choice([1, 2, 2, 3, 4, 26])], []
        for _ in range(rnd.randrange(1, 6)):
            words += [rnd.choice(letters) for _ in range(rnd.randrange(1, 14))] * rnd.choice([1, 1, 2, 3, 4, 5, 7])
            words = words[: -rnd.randrange(3) or None]
        yield " ".join(words).encode()


def test_runs_equal_brute_force():
    texts = [b"", b" ", *periodic_texts(800)]
    for (words, runs), text in zip(periods.find(texts), texts, strict=True):
        assert words == text.split() and runs == brute_runs(words)
        assert periods.collapse(words, runs) == brute_collapse(words, runs)


def test_only_near_occurrences_in_context_are_taken():
    codes = np.array([1, 2] * 3_000 + list(range(10, 3_000)))
    at, lag, context = periods.occurrences(codes, np.array([0, len(codes)]))
    assert set(lag.tolist()) == {2} and set(context.tolist()) == {3} and len(at) == 6_000 - 4
    # A word that fills the text: one occurrence a word, not all earlier ones.
    assert len(periods.occurrences(np.zeros(50_000, int), np.array([0, 50_000]))[0]) == 49_999


def test_runs_of_a_table(spark):
    repeated = ("to be or not " * 9).strip()
    rows = [*enumerate(ODD), (100, repeated), (100, repeated), (None, repeated), (101, prose(3, 30_000) + " x y" * 200)]
    df = documents(spark, rows).withColumn("length", F.lit("mine"))
    found = periods.periodic_runs(df).collect()
    assert len(found) == len(rows) and {row.length for row in found} == {"mine"}
    for row in found:
        words = (row.text or "").encode().split()
        runs = [(run.start, run["length"], run.period) for run in row.runs]
        assert row.n_words == len(words)
        if len(words) < 500:
            assert runs == brute_runs(words)
        assert bytes(row.collapsed) == brute_collapse(words, runs)
    by_id = {row.doc_id: row.runs for row in found}
    assert [(r.start, r["length"], r.period) for r in by_id[100]] == [(0, 36, 4)]
    assert [(r.start, r["length"], r.period) for r in by_id[101]] == [(30_000, 400, 2)]
    assert periods.periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(df.withColumn("runs", F.lit(1)))


def test_run_query_equals_brute_force(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    expected = {}
    for doc_id, text in texts:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        head = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        expected[doc_id] = (*head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapse(words, runs)).hexdigest())
    rows = QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    assert {row.doc_id: tuple(row)[1:] for row in rows} == expected and any(row.n_runs for row in rows)


def brute_matches(text, templates, weights, cover):
    words, out = licenses.words_in(text or ""), []
    for number, template in enumerate(templates):
        own = template.words
        total = sum(weights[w.encode()] for w in own)
        for place in range(1 - len(own), len(words)):
            covered = sum(weights[w.encode()] for k, w in enumerate(own) if 0 <= place + k < len(words) and words[place + k] == w)
            stretch = " " + " ".join(words[max(place, 0) : place + len(own)]) + " "
            keys = all(f" {' '.join(licenses.words_in(key))} " in stretch for key in template.keys)
            if covered and 100 * covered >= (100 if template.exact else cover) * total and keys:
                out.append((max(place, 0), template.label, number, covered, total, template.exact))
    return sorted(out)


def license_texts():
    rnd, texts = random.Random(8), []
    for template in licenses.TEMPLATES:
        for share in (0.0, 0.0, 0.1, 0.2, 0.4):
            words = [w if rnd.random() >= share else rnd.choice(["the", "x", "license", "mit"]) for w in template.text.split()]
            start, stop = rnd.choice([(0, None), (0, None), (1, None), (0, -1)])
            texts.append(" ".join([prose(rnd.random(), rnd.randrange(4), 9), *words[start:stop], prose(rnd.random(), rnd.randrange(4), 9)]))
    return texts + ["Under THE MIT License. under the mit license", "cc-by-nc cc by nc", "ünder the mit license", "the mit license under"]


@pytest.mark.parametrize("cover", [60, licenses.COVER])
def test_notices_equal_brute_force(spark, cover):
    texts = [*ODD[:7], *license_texts()]
    df = documents(spark, [*enumerate(texts), (1, texts[-1]), (None, texts[-1])]).withColumn("label", F.lit("mine"))
    rows, counts = licenses.document_counts(df)
    assert rows == len(texts) + 2
    for word, n in counts.items():
        assert n == sum(word.decode() in licenses.words_in(t or "") for t in [*texts, texts[-1], texts[-1]])
    weights = licenses.idf_weights(rows, counts)
    found = licenses.scan_licenses(df, cover=cover).collect()
    assert len(found) == len(texts) + 2
    seen = collections.Counter()
    for row in found:
        assert row.n_words == len(licenses.words_in(row.text or "")) and row.label == "mine"
        got = [(m.first_word, m.label, m.template, m.covered, m.weight, m.exact) for m in row.matches]
        assert got == brute_matches(row.text, licenses.TEMPLATES, weights, cover)
        seen.update(m.label for m in row.matches)
    assert set(seen) == {template.label for template in licenses.TEMPLATES}


def test_notices_of_odd_tables(spark):
    assert licenses.scan_licenses(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(documents(spark, []).withColumn("matches", F.lit(1)))
    with pytest.raises(ValueError):
        licenses.scan_licenses(documents(spark, []), [licenses.Template("x", " . ")])
    long = "the of license " * 40_000 + "released under the MIT license " + "license the " * 10
    (row,) = licenses.scan_licenses(documents(spark, [(0, long)])).collect()
    assert [m.first_word for m in row.matches if m.exact] == [120_001]


def test_run_and_license_queries_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    for name, sql in ORACLES.items():
        result = con.execute(sql)
        theirs = sorted((dict(zip([d[0] for d in result.description], row, strict=True)) for row in result.fetchall()), key=lambda r: r["doc_id"])
        ours = sorted((row.asDict() for row in QUERIES[name](spark, SMALL).collect()), key=lambda r: r["doc_id"])
        assert ours == theirs
    assert license_sql(licenses.TEMPLATES[:1], 70).count("VALUES") == 3


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path(BYTE_VOCABULARY))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))


def brute_alignment(text, both):
    """Groups and linked id pairs by byte offsets; the vocabularies are spelled in a way of their own."""
    if not text:
        return [], []
    a, b = both
    alphabet = {char: byte for char, byte in alignment.byte_alphabet().items()}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled_a = [bytes(alphabet[char] for char in a.id_to_token(i)) for i in ids_a]
    spelled_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        byte = piece.startswith("<0x") and len(piece) == 6
        spelled_b.append(bytes.fromhex(piece[3:5]) if byte else piece.replace("▁", " ").encode())
    if b"".join(spelled_a) != (" " + text).encode() or b"".join(spelled_b) != (" " + text).encode():
        return [], []
    ends_a, ends_b = np.cumsum([len(s) for s in spelled_a]).tolist(), np.cumsum([len(s) for s in spelled_b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append((ids_a[i:x], ids_b[j:y]))
        i, j = x, y
    links, j = [], 0
    for i, id_a in enumerate(ids_a):
        low, high = (ends_a[i - 1] if i else 0), ends_a[i]
        while ends_b[j] <= low:
            j += 1
        k = j
        while k < len(ids_b) and (ends_b[k - 1] if k else 0) < high:
            links.append((id_a, ids_b[k]))
            k += 1
    return groups, links


def spelled(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


SPECIAL = ["<|endoftext|> <s></s><unk> <0x41>", " a▁b", " x", "a\x00b", "ﬁ ½ Ａ", "z" * 3_000, " " * 3_000]


def test_shared_ends_equal_sets():
    rnd = np.random.default_rng(3)
    for share_a, share_b in ((0.5, 0.5), (0.05, 0.9), (0.9, 0.02), (0.01, 0.01)):
        for _ in range(50):
            bounds = np.cumsum(rnd.integers(1, 400, 6))
            a, b = (np.union1d(np.flatnonzero(rnd.random(bounds[-1]) < s) + 1, bounds) for s in (share_a, share_b))
            stops = np.searchsorted(a, bounds) + 1
            cuts = alignment.shared_ends(a, b, np.concatenate([[0], stops[:-1]]), stops)
            assert a[cuts].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_shared_ends_look_each_end_up_once(monkeypatch):
    rnd, asked, search = np.random.default_rng(4), [], np.searchsorted
    a, b = (np.append(np.flatnonzero(rnd.random(5_000) < 0.05) + 1, 5_001) for _ in range(2))
    monkeypatch.setattr(np, "searchsorted", lambda x, v, *more: asked.append(np.size(v)) or search(x, v, *more))
    alignment.shared_ends(a, b, np.array([0]), np.array([len(a)]))
    assert sum(asked) <= len(a)


def test_alignment_of_a_table(spark, both, monkeypatch):
    texts = [t for t in ODD if t is None or len(t) < 1_000] + SPECIAL + random_texts(25)
    rows = [*enumerate(texts), (1, texts[-1]), (None, texts[-1])]
    df = documents(spark, rows).withColumn("n", F.lit("mine"))
    paths = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_MODEL)
    aligned = alignment.numbered(alignment.align_tokens(df, *paths, public_tokenizers.PATTERN), *df.columns, "n_a", "n_b", "n_groups", "n_links", "groups")
    expected = {text: brute_alignment(text, both) for text in set(texts)}
    counts, n_empty = collections.Counter(), 0
    for _, text in rows:
        counts.update(expected[text][1])
        n_empty += not expected[text][0]
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    found = aligned.collect()
    assert len(found) == len(rows) and {row.n for row in found} == {"mine"} and 3 <= n_empty < 30
    for row in found:
        groups, links = expected[row.text]
        assert (row.n_groups, row.n_links, row.groups) == (len(groups), len(links), spelled(groups))
        assert (row.n_a, row.n_b) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups))
        assert {(link.a, link.b): link.times for link in row.links} == collections.Counter(links)
    pairs = alignment.linked_pairs(aligned)
    assert {(p.a, p.b): (p["count"], p.best) for p in pairs.collect()} == {(a, b): (n, n == highest[b]) for (a, b), n in counts.items()}
    for share in (alignment.HEAVY_SHARE, 50, 1):  # all pairs broadcast, some, none
        monkeypatch.setattr(alignment, "HEAVY_SHARE", share)
        sums = {row.row: (row.n_best, row.count_sum) for row in alignment.weigh(aligned, pairs, "row").collect()}
        for row in found:
            links = expected[row.text][1]
            best = sum(counts[link] == highest[link[1]] for link in links)
            assert sums.get(row.row, (0, 0)) == (best, sum(counts[link] for link in links))
    empty = alignment.align_tokens(documents(spark, []), *paths, public_tokenizers.PATTERN)
    assert empty.count() == 0 and alignment.linked_pairs(empty).count() == 0
    with pytest.raises(ValueError):
        alignment.align_tokens(df.withColumn("links", F.lit(1)), *paths, public_tokenizers.PATTERN)


def test_long_texts_take_the_other_library(both):
    with open(public_tokenizers.path(BYTE_VOCABULARY), "rb") as a, open(public_tokenizers.path(PIECE_MODEL), "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read(), public_tokenizers.PATTERN)
    for text in random_texts(60, seed=2) + SPECIAL:
        assert aligner.encode(" " + text) == both[0].encode(" " + text, add_special_tokens=False).ids
    for text in (" " * (alignment.LONG_TEXT * 20), "z" * (alignment.LONG_TEXT + 1), prose(1, 20_000)):
        n_a, n_b, n_groups, n_links, *_ = (column[0].as_py() for column in aligner.align([text.encode()]))
        assert n_a > 0 and n_links == n_a + n_b - n_groups


def test_alignment_query_equals_brute_force(spark, both):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    expected = {doc_id: brute_alignment(text, both) for doc_id, text in texts.items()}
    counts = collections.Counter(link for _, links in expected.values() for link in links)
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = QUERIES["op13_token_alignment"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        groups, links = expected[row.doc_id]
        sha = hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[link] == highest[link[1]] for link in links)
        assert (row.n_a, row.n_b) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups))
        assert (row.n_groups, row.n_links, row.groups_sha256) == (len(groups), len(links), sha)
        assert (row.n_best, row.count_sum) == (best, sum(counts[link] for link in links))
