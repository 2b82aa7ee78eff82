"""The pipeline, stage by stage against brute force, and the registered queries against SQL."""

import hashlib
import re

import duckdb
import public_tokenizers
import pytest
from conftest import SMALL
from differential import compare, connect
from llm.helpers import words
from llm.test_pairs import brute_components, brute_lines
from llm.test_text import WORD, brute_counts, reference  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from telemetry_lake.llm.common import table, written
from telemetry_lake.llm.quality import judge
from telemetry_lake.llm.queries import ORACLES, QUERIES


def lowered(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def has_window(text, items):
    own = lowered(text)
    for item in items:
        v = lowered(item)
        size = min(10, len(v))
        if size and {tuple(v[k : k + size]) for k in range(len(v) - size + 1)} & {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}:
            return True
    return False


def test_stages(spark, reference):  # noqa: F811
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "byte_bpe"]
    docs = table(spark, SMALL, "documents").withColumn("kept", F.lit("mine"))
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        assert name == "byte_bpe" or docs.columns == corpus_pipeline.COLUMNS
        frames.append(docs.collect())
    quality, lines, unique, clean, coded = frames

    trusted = table(spark, SMALL, "labels").filter("quality = 1").select("doc_id")
    verdicts = judge(table(spark, SMALL, "documents").select("doc_id", "text"), trusted)
    assert {r.doc_id for r in quality} == {r.doc_id for r in verdicts.filter("kept").collect()}
    for r in quality:
        n, _, _, _, repeated = brute_counts(r.text)
        assert n >= 20 and 100 * repeated <= 30 * n

    cut = brute_lines([(r.doc_id, r.text) for r in quality])
    before = {r.doc_id: r for r in quality}
    expected = {i: t for (i, old), t in cut.items() if t == old or words(t)}
    assert {r.doc_id: r.text for r in lines} == expected
    assert all(r.n_chars == (len(r.text) if r.text != before[r.doc_id].text else before[r.doc_id].n_chars) for r in lines)

    label = brute_components([(r.doc_id, r.text) for r in lines], 5, 80)
    assert {r.doc_id for r in unique} == {i for i, first in label.items() if i == first}

    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in unique if not has_window(r.text, items)}
    assert len(clean) < len(unique)

    texts = {r.doc_id: r.text for r in clean}
    assert len(coded) == len(texts)
    for r in coded:
        assert r.ids == reference.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_stages_take_nulls_repeats_and_nothing(spark):
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id int, gone string"
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, None, None, None, 1, "x")] * 2 + [(2, text, "en", "s", 3, 1, "x"), (None, text, None, "s", 1, 1, None), (3, None, None, None, None, 1, None)]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, ddl)
        got = [r.doc_id for r in stage(spark, docs, SMALL).collect()]
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        if name == "quality_rules":
            assert sorted(map(str, got)) == ["1", "1", "2", "None"]
        elif name == "line_dedup":
            assert sorted(map(str, got)) == ["1", "1", "3"]
        elif name == "jaccard_join":
            assert sorted(map(str, got)) == ["1", "3"]
        else:
            assert len(got) == 5


def test_documents_are_told_apart_by_id_and_text(spark):
    texts = [" ".join(f"w{k}_{i}" for i in range(30)) for k in range(4)]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(7, texts[0]), (7, texts[1]), (3, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]), (9, texts[3]), (None, None), (None, " "), (5, " "), (5, " ")]
    docs = spark.createDataFrame([(i, t, None, None, k) for k, (i, t) in enumerate(rows)], ddl)
    kept = sorted(r.n_chars for r in corpus_pipeline.jaccard_join(spark, docs, SMALL).collect())
    # One of each text: of equal rows the first by its other columns; rows without words stay.
    assert kept == [0, 2, 3, 6, 7, 8, 9, 10]
    high = docs.withColumn("doc_id", F.col("doc_id") + F.lit(2**62))
    assert sorted(r.n_chars for r in corpus_pipeline.jaccard_join(spark, high, SMALL).collect()) == kept


def test_every_operator_has_a_query():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(ORACLES) < set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, con, name):
    problem, rows = compare(spark, con, name, QUERIES[name], ORACLES[name], SMALL)
    assert not problem and rows > 0


def test_decoded_bytes_are_the_texts(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    coded = corpus_pipeline.byte_bpe(spark, table(spark, SMALL, "documents"), SMALL)
    for r in coded.select("doc_id", "decoded_sha256").collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert public_tokenizers.path(corpus_pipeline.VOCABULARY)
