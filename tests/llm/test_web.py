"""URL filters and WARC archives."""

import base64
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import urls, warc


def brute_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [
        (len(h) + len(p), len(h), p, h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, default)


@pytest.mark.parametrize("rules", [urls.RULES, (), (
    ("block", "a", "/"), ("allow", "b.a", "/x"), ("block", "c.b.a", "/x/y"), ("allow", "b.a", "/"), ("block", "ab", ""), ("block", "b.a", "/x/"),
    ("allow", "a-b", "/"), ("block", "é.a", "/"),
)])
def test_verdicts(spark, rules):
    rnd = random.Random(1)
    hosts = ["a", "b.a", "c.b.a", "d.c.b.a", "ab", "x.ab", "a-b", "é.a", "B.A", "org", "example.org", "m.Example.ORG", "com", "q.com", "borg", "", "a."]
    paths = ["", "/", "/x", "/x/", "/x/y/z", "/es/", "/es", "/en/12", "/fr/1?q=/de/", "/de/#x", "?x", "#y://z"]
    rows = [(i, f"http://{rnd.choice(hosts)}{rnd.choice(paths)}") for i in range(400)]
    rows += [(900, None), (901, ""), (902, "no scheme"), (903, "://"), (None, "http://a/"), (0, "https://b.a/x/1"), (904, "x://a\n/b\nc"),
             (905, "http://" + "q." * 20_000 + "b.a/x/" + "y" * 50_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("part", F.lit("mine")).withColumn("k", F.lit(1))
    got = urls.judge_urls(df, rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((i, *brute_verdict(u, rules)) for i, u in rows), key=key)
    assert urls.judge_urls(df.limit(0), rules).count() == 0


def record(number, payload, extra=b""):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{number}>\r\n".encode()
    return head + extra + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_magic_inside_payloads_starts_no_record(spark, folder, packed):
    inner = record(77, b"inner")
    payloads = [b"", b"plain", inner, b"x" + inner + inner, b"WARC/1.1\r\n", b"\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc", inner + b"WARC/1.1\r\n" * 5,
                b"\xff\xfe binary \x00", b"WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n", "é".encode() * 3_000]
    random.Random(3).shuffle(payloads)
    for name, own in (("one", payloads), ("two", payloads[::-1]), ("none", [])):
        raw = b"".join(record(i, p) for i, p in enumerate(own))
        with (gzip.open if packed else open)(f"{folder}/{name}.warc" + ".gz" * packed, "wb") as file:
            file.write(raw)
    if not packed:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = sorted((r.record_id, bytes(r.block)) for r in warc.read_archive(spark, folder).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((f"<urn:page:{i}>", p) for own in (payloads, payloads[::-1]) for i, p in enumerate(own))


def test_reachability_is_by_chains(spark):
    links = [("f", 0, 10), ("f", 10, 30), ("f", 20, 30), ("f", 30, 99), ("g", 5, 10), ("h", 0, None), ("i", 0, 0)]
    links += [("long", i, i + 1) for i in range(300)]
    got = warc.reachable(spark.createDataFrame(links, "path string, start bigint, following bigint"))
    found = {(r.path, r.start) for r in got.collect()}
    assert found == {("f", 0), ("f", 10), ("f", 30), ("h", 0), ("i", 0), *(("long", i) for i in range(300))}


@pytest.mark.parametrize("least", [0, 4])
def test_archive_round_trip(spark, folder, least):
    payloads = [None, "", "abc", "abc", "abcd", "abcd", "é\r\n\r\nWARC/1.1\r\n", "x" * 100_000, record(1, b"zz").decode(), "abcd"]
    rows = [(10 - i, f"http://h/{i}" if i % 3 else None, p) for i, p in enumerate(payloads)] + [(None, "u\r\nv", "abcd"), (5, "u", "abcd")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    warc.write_archive(pages, f"{folder}/w", least)
    got = warc.read_archive(spark, f"{folder}/w").collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, p in rows:
        if i is not None:
            first[p or ""] = min(first.get(p or "", i), i)
    names = {None: None, **{f"<urn:page:{i}>": i for i in range(20)}}
    found = sorted(((names[r.record_id] is None, names[r.record_id] or 0), r.record_type, names[r.refers_to], r.payload_length, r.payload_digest, bytes(r.block)) for r in got)
    expected = []
    for i, _, p in rows:
        raw = (p or "").encode()
        again = len(raw) >= least and i != first[p or ""]
        digest = "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected.append(((i is None, i or 0), "revisit" if again else "response", first[p or ""] if again else None, len(raw), digest, b"" if again else raw))
    assert found == sorted(expected)
    assert {r.target_uri for r in got} == {None, "u", "u  v", *(f"http://h/{i}" for i in range(10) if i % 3)}


def test_separators_of_lines_in_urls_are_no_header_ends(spark, folder):
    urls = [f"http://h/{sep}Content-Length: 3{sep}x" for sep in "\x85\u2028\u2029\x0b\x0c"]
    urls += [f"http://h/{sep}WARC-Refers-To: <urn:page:1>" for sep in "\x85\u2028\u2029"] + ["http://h/\r\nContent-Length: 3\r\n"]
    rows = [(i, url, f"payload of page {i}") for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archive(pages, f"{folder}/w")
    got = {r.record_id: r for r in warc.read_archive(spark, f"{folder}/w").collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        r = got[f"<urn:page:{i}>"]
        assert (bytes(r.block).decode(), r.refers_to, r.record_type) == (html, None, "response")
        assert r.target_uri == url.replace("\r", " ").replace("\n", " ").strip() or r.target_uri == url.replace("\r", " ").replace("\n", " ")


def test_an_empty_table(spark, folder):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.through_archive(none).count() == 0
    assert os.path.isdir(folder)
