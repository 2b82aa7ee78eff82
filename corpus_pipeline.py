"""The corpus pipeline: ``documents`` through five stages, each of which calls one text operator.

Every stage takes all that its predecessor kept and returns the columns of ``documents``; the last one returns the
encoded documents. Texts are told apart by id and checksum, so that rows which repeat an id cannot be mixed up. Rows
with NULLs in any column pass through unless a stage's rule is about their text; empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.bpe import encode_decode
from telemetry_lake.llm.common import sized, table, written
from telemetry_lake.llm.decontaminate import find_contamination
from telemetry_lake.llm.jaccard import one_of_each
from telemetry_lake.llm.lines import dedupe_lines
from telemetry_lake.llm.quality import judge

VOCABULARY = "byte_bpe_50k.tiktoken"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, rejected: DataFrame, purpose: str) -> DataFrame:
    """``docs`` without the rows whose id and checksum are in ``rejected``; the texts are not shuffled if these are few."""
    rejected = sized(written(rejected.select(F.col("doc_id").alias("_id"), F.col("_sum").alias("_gone")).distinct(), purpose))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_gone"))
    return docs.join(rejected, same, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    judged = judge(docs.select("doc_id", "text", F.xxhash64("text").alias("_sum")), trusted)
    return _without(docs.select(*COLUMNS), judged.filter("NOT kept"), "pipeline-rejected")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has; those that lose all their words go."""
    left = dedupe_lines(docs.select(*COLUMNS))
    left = left.filter((F.col("_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.when(F.col("_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id, once."""
    return one_of_each(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = find_contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, their number, and a digest of the bytes they decode to."""
    coded = encode_decode(docs.select(*COLUMNS), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# SQL has neither the hash of the quality rules nor the encoding; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
