"""Named queries of the text operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import language, span_queries, toxicity
from telemetry_lake.llm.bpe import encode_decode
from telemetry_lake.llm.common import table
from telemetry_lake.llm.decontaminate import find_contamination
from telemetry_lake.llm.jaccard import join_similar
from telemetry_lake.llm.lines import dedupe_lines
from telemetry_lake.llm.quality import judge
from telemetry_lake.llm.suffixes import remove_repeats
from telemetry_lake.llm.urls import judge_urls
from telemetry_lake.llm.warc import base32, page_of, through_archive

VOCABULARY = "byte_bpe_50k.tiktoken"


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.start)
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    examples = toxicity.sample(docs, table(spark, sf_dir, "labels"), learn=_fold(5) != 0)
    model = toxicity.train([text for text, _ in examples], [toxic for _, toxic in examples])
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        (_fold(5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    examples = language.sample(docs, learn=_fold(3) != 1)
    model = language.fit([text for text, _ in examples], [lang for _, lang in examples])
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (_fold(3) == 1).alias("held_out"),
        F.col("language").alias("lang_pred"),
        F.col("cosine").alias("score"),
        "rejected",
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=85)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return judge(docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = through_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    # The digest of a response is taken from the bytes that were read back.
    own = F.when(F.col("record_type") == "response", base32(F.sha1("block")))
    own_bytes = F.when(F.col("record_type") == "response", F.octet_length("block").cast("long"))
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.coalesce(own_bytes, "payload_length").alias("payload_bytes"),
        F.coalesce(own, F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op5_url_filters": op5_url_filters,
    "op6_warc": op6_warc,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_rules": op4_quality_rules,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
    **span_queries.QUERIES,
}

# The words of a text, numbered from 0, for both tables.
_WORDS = r"""
    SELECT {key} AS k, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p, len(w) AS n
    FROM (SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM {table}) WHERE len(w) > 0"""

ORACLES = {
    **span_queries.ORACLES,
    "op8_line_dedup": r"""
WITH l AS (
    SELECT doc_id, p, parts[p] AS line,
           list_sort(list_distinct(list_filter(regexp_split_to_array(lower(parts[p]), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p
          FROM documents WHERE text IS NOT NULL)),
c AS (SELECT s, row_number() OVER (ORDER BY min((doc_id, p))) AS c, min((doc_id, p)) AS first FROM l WHERE len(s) >= 1 GROUP BY s),
t AS (SELECT c, len(s) AS n, unnest(s) AS w FROM c),
df AS (SELECT w, count(*) AS f FROM t GROUP BY w),
pre AS (SELECT c, w FROM (SELECT c, n, t.w, row_number() OVER (PARTITION BY c ORDER BY f, t.w) AS r FROM t JOIN df USING (w))
        WHERE r <= n - ceil(80 * n / 100) + 1),
pairs AS (SELECT DISTINCT a.c AS a, b.c AS b FROM pre a JOIN pre b ON a.w = b.w AND b.c < a.c),
sim AS (SELECT DISTINCT a FROM pairs JOIN c x ON x.c = a JOIN c y ON y.c = b
        WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
j AS (SELECT l.doc_id, l.p, l.line, (c.c IS NOT NULL AND ((l.doc_id, l.p) > c.first OR sim.a IS NOT NULL)) AS gone
      FROM l LEFT JOIN c ON c.s = l.s LEFT JOIN sim ON sim.a = c.c)
SELECT d.doc_id, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]'))::BIGINT AS n_lines,
       count(*) FILTER (gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op9_suffix_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(lower(hex(encode(text))), '') AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS s
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w JOIN m USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM r),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, g),
c AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
      FROM spans GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE
           array_to_string(list_transform(range(1, len(starts) + 2), lambda k:
               substr(h, 2 * coalesce(ends[k - 1], 0) + 1, 2 * (coalesce(starts[k], length(h) // 2) - coalesce(ends[k - 1], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
walk AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, coalesce(c, 0)::BIGINT AS n_links
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS m FROM walk GROUP BY a) USING (doc_id)
     LEFT JOIN (SELECT a AS doc_id, count(*) AS c FROM links GROUP BY a) USING (doc_id)
""",
    "op5_url_filters": r"""
WITH u AS (
    SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] END, '') AS rest FROM pages),
h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
    SELECT h.*, rh || rp AS rule, verdict FROM h LEFT JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
       arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM m GROUP BY page_id
""",
    "op6_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
""",
    "op10_decontamination": f"""
WITH dw AS ({_WORDS.format(key="doc_id", table="documents")}),
     iw AS ({_WORDS.format(key="item_id", table="benchmark")}),
     patterns AS (
        SELECT DISTINCT k AS item, len(v) AS m, array_to_string(v, ' ') AS v
        FROM (SELECT k, n, p, list(word) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS v FROM iw)
        WHERE p <= greatest(n - 10, 0)),
     lens AS (SELECT DISTINCT m FROM patterns),
     dwin AS (
        SELECT k, p, n, list(word) OVER (PARTITION BY k ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS v FROM dw),
     found AS (
        SELECT DISTINCT d.k, d.p, t.m, t.item
        FROM dwin d JOIN lens l ON l.m <= len(d.v)
        JOIN patterns t ON t.m = l.m AND t.v = array_to_string(d.v[1:l.m], ' ')),
     hit AS (SELECT DISTINCT k, p + o AS p FROM (SELECT k, p, unnest(range(m)) AS o FROM found)),
     hits AS (SELECT k, count(*) AS n_hit FROM hit GROUP BY k),
     items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
               FROM (SELECT DISTINCT k, item::VARCHAR AS item FROM found) GROUP BY k),
     nw AS (SELECT k, count(*) AS n_words FROM dw GROUP BY k)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN nw ON nw.k = doc_id LEFT JOIN hits ON hits.k = doc_id LEFT JOIN items ON items.k = doc_id
""",
}
