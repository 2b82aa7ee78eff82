"""Named queries of the operators that report spans of a text: runs, notices, aligned tokens; and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import licenses
from telemetry_lake.llm.alignment import align_tokens, linked_pairs, numbered, weigh
from telemetry_lake.llm.common import table, words_of
from telemetry_lake.llm.periods import periodic_runs

BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Texts of ids whose checksum ends in 0 become periodic from a word that depends on it, all others stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = words_of(F.col("text"))
    n = F.size("_w")
    start = (F.col("_g") % n).cast("int")
    period = 1 + F.floor((n - start) / (3 + F.col("_g") % 8)).cast("int")
    word = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.element_at("_w", F.when(i < start, i).otherwise(start + (i - start) % period) + 1),
    )
    chosen = docs.select("doc_id", "text", g.alias("_g"), F.when(h % 10 == 0, words).alias("_w"))
    return chosen.select("doc_id", F.when(F.size("_w") > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    # The run with the greatest exponent; runs come ordered by start and period, so the first of equals stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda top, run: F.when(run.length * top.period > top.length * run.period, run).otherwise(top),
    )
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    best = F.when(F.size("runs") > 0, best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.floor(1000 * best.length / best.period).alias("exponent_milli"),
        _sha(F.array_join(lines, "")).alias("runs_sha256"),
        _sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda match: match.exact)

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda match: match.label))), ",")

    places = F.transform(base, lambda match: match.first_word)
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda match: match.covered / match.weight)), F.lit(0.0)).alias("score"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary, model = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_MODEL)
    aligned = align_tokens(docs, vocabulary, model, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_a") > 0, _sha(F.col("groups"))).otherwise(F.lit(""))
    rows = numbered(aligned, "doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"))
    sums = weigh(rows, linked_pairs(rows), "row")
    return rows.drop("links").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )


QUERIES = {
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_token_alignment": op13_token_alignment,
}


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql(templates: list[licenses.Template], cover: int) -> str:
    """The license scan without an index: every word of a template against every equal word of every document."""
    words = ", ".join(
        f"({number}, {position}, {_literal(word)})" for number, t in enumerate(templates) for position, word in enumerate(t.words)
    )
    heads = ", ".join(
        f"({number}, {_literal(t.label)}, {len(t.words)}, {100 if t.exact else cover}, {str(t.exact).lower()})" for number, t in enumerate(templates)
    )
    keys = ", ".join(f"({number}, {_literal(' '.join(licenses.words_in(key)))})" for number, t in enumerate(templates) for key in t.keys)
    return rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
tw(t, r, word) AS (VALUES {words}),
th(t, label, len, cover, base) AS (VALUES {heads}),
tk(t, phrase) AS (VALUES {keys}),
dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
lw AS (SELECT * FROM dw WHERE word IN (SELECT word FROM tw)),
idf AS (
    SELECT word, 1 + floor(1000 * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(DISTINCT doc_id) + 1)))::BIGINT AS weight
    FROM (SELECT DISTINCT word FROM tw) LEFT JOIN lw USING (word) GROUP BY word),
total AS (SELECT t, sum(weight) AS total FROM tw JOIN idf USING (word) GROUP BY t),
placed AS (
    SELECT doc_id, t, i - r AS p, sum(weight) AS covered FROM lw JOIN tw USING (word) JOIN idf USING (word) GROUP BY ALL),
good AS (
    SELECT doc_id, t, p, label, base, covered / total AS share, array_to_string(w[greatest(p, 0) + 1 : p + len], ' ') AS stretch
    FROM placed JOIN total USING (t) JOIN th USING (t) JOIN d USING (doc_id) WHERE 100 * covered >= cover * total),
m AS (
    SELECT * FROM good
    WHERE NOT EXISTS (SELECT 1 FROM tk WHERE tk.t = good.t AND NOT contains(' ' || stretch || ' ', ' ' || phrase || ' '))),
s AS (
    SELECT doc_id, count(*) FILTER (base) AS n_base, min(p) FILTER (base) AS first_word, max(p) FILTER (base) AS last_word,
           list_distinct(list(label) FILTER (base)) AS b, list_distinct(list(label)) AS l, max(share) AS score
    FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(l), ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN s USING (doc_id)
"""


ORACLES = {
    "op12_license_scan": license_sql(licenses.TEMPLATES, licenses.COVER),
    # The checksum is folded bit by bit; runs are islands of equal words at one lag, the smallest lag of a stretch counts.
    "op11_periodic_runs": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda ch: list_transform(range(8), lambda k: (ascii(ch)::BIGINT >> k) & 1)))),
               lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h
    FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
f AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM e WHERE n > 0),
x AS (SELECT *, unnest(range(n)) AS i FROM f),
words AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM x),
eq AS (
    SELECT x.doc_id, x.i, x.i - y.i AS q
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
seg AS (
    SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM eq) GROUP BY doc_id, q, island),
runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM seg WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
per AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
           first({'start': start, 'length': length, 'period': period} ORDER BY length::DOUBLE / period DESC, start, period) AS best
    FROM runs GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
    FROM words WHERE NOT EXISTS (
        SELECT 1 FROM runs WHERE runs.doc_id = words.doc_id AND i >= start + period AND i < start + length) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
       best.period::BIGINT AS period, ((1000 * best.length) // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}
