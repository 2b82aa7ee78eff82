"""WARC archives: written with revisit records, and read back by verifying the chain of record boundaries.

Writing. A record per row; of rows with equal payloads one is the response and the others are revisits that name
it. Spark's text writer puts the record end (two empty lines) after each record and commits whole files, so
a lost task leaves nothing behind.

Reading. The text reader cuts archives at the magic ``WARC/1.1`` line, in splits of any file. Every cut is a
candidate record. A prefix sum over the pieces, first in each split and then over the splits of a file, gives
candidates their byte offsets, and the length in its header gives a candidate the offset of its successor.
Pointer jumping from the start of each file keeps the candidates that a chain of records reaches: a magic
line inside a payload starts no record. Pieces between two kept candidates are put together again.

Defined results: a NULL html is an empty payload; NULL urls and ids leave their header out (a NULL id reads back
as NULL); line breaks in a url become blanks, other separators of lines (U+0085, U+2028, U+2029) stay; rows that repeat
the smallest id of a payload are responses too; an empty table gives an archive without records; very long payloads are
records like any other. Other columns of the pages are not written, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.common import sized, written
from telemetry_lake.session import scratch_dir

MAGIC, END, BREAK = "WARC/1.1\r\n", "\r\n\r\n", "\r\n"


def base32(hexadecimal: Column) -> Column:
    """Base 32 (A-Z, 2-7) of 40 hexadecimal digits: every five of them are four digits of the result."""
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK)), F.lit(""))


def write_archive(
    pages: DataFrame, folder: str, least_revisit: int = 0, key: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write a record per row into gzip archives in ``folder``.

    Rows whose payload of at least ``least_revisit`` bytes equals that of a row with a smaller key are revisits.
    Digests that occur once never leave their task with a payload; the digests of repeated payloads are
    counted with map-side sums, so that a payload that holds most rows is no hot key.
    """
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    sized = rows.filter(F.octet_length("payload") >= least_revisit)
    first = sized.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = written(first.select("digest", "first"), "warc-repeated")
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ((F.col("id") > F.col("first")) | F.col("id").isNull())
    digest = F.concat(F.lit("sha1:"), base32(F.col("digest")))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        _header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        _header("WARC-Target-URI", F.translate("url", "\r\n", "  ")),
        _header("WARC-Payload-Digest", digest),
        _header("X-Payload-Length", F.octet_length("payload")),
        F.lit(f"Content-Type: text/html; charset=utf-8{BREAK}"),
        _header("Content-Length", F.octet_length(block)),
        F.lit(BREAK),
        block,
    )
    rows.select(record).write.option("lineSep", END).option("compression", "gzip").text(folder)


def _field(head: Column, name: str) -> Column:
    """Value of a header, NULL if it is not there."""
    # A header begins behind the line break of the one before: a value may hold what other alphabets take for one.
    found = F.regexp_extract(head, rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def pieces_of(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between magic lines: ``path``, ``block`` (start of the split), ``n`` (order in it) and ``value``.

    Written once, which fixes the numbers of the pieces.
    """
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return written(
        lines.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("n"), "value",
        ),
        "warc-pieces",
    )


def parsed(pieces: DataFrame) -> DataFrame:
    """Adds ``head``, the length field of the header and ``body``, the bytes up to where the block begins."""
    df = pieces.withColumn("head", F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1)))
    length = F.regexp_extract("head", r"(?i)(?:^|\n)Content-Length:[ \t]*([0-9]+)[ \t]*(?:\r|\n|\z)", 1).try_cast("long")
    return df.withColumn("length", length).withColumn("body", F.octet_length("head") + len(END))


def candidates(pieces: DataFrame) -> DataFrame:
    """A narrow row per piece: ``n``, ``path`` (as a hash of 64 bits), ``start`` (offset of its magic; negative before the first one),
    ``following`` (offset of the successor; NULL without a readable header) and ``whole`` (the piece has it all)."""
    narrow = parsed(pieces).select(
        F.xxhash64("path").alias("path"), "block", "n", (F.octet_length("value") + len(MAGIC)).alias("size"),
        (F.col("body") + F.col("length")).alias("needed"),
    )
    ahead = Window.partitionBy("path", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    totals = narrow.groupBy("path", "block").agg(F.sum("size").alias("total"))
    base = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("path", "block", F.coalesce(F.sum("total").over(base), F.lit(0)).alias("base"))
    within = narrow.withColumn("within", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    placed = within.join(totals, ["path", "block"]).withColumn("start", F.col("base") + F.col("within") - len(MAGIC))
    return placed.select(
        "n", "path", "start", (F.col("start") + len(MAGIC) + F.col("needed") + len(END)).alias("following"),
        F.coalesce(F.col("size") - len(MAGIC) >= F.col("needed"), F.lit(False)).alias("whole"),
    )


def reachable(links: DataFrame) -> DataFrame:
    """``(path, start)`` of the candidates that the chain from each file's start reaches.

    ``links`` has ``(path, start, following)``. Each round doubles the length of the jumps: after k rounds the
    first 2^k records of every file are reached. Both sides grow with the archives, so no side is broadcast.
    """
    jumps = written(links.filter("following > start"), "warc-links")
    reached = written(links.filter("start = 0").select("path", "start"), "warc-reached")
    count = reached.count()
    while True:
        ahead = reached.join(jumps.hint("merge"), ["path", "start"]).select("path", F.col("following").alias("start"))
        ahead = ahead.join(links.select("path", "start").hint("merge"), ["path", "start"], "left_semi")
        reached = written(reached.union(ahead).distinct(), "warc-reached")
        grown = reached.count()
        if grown == count:
            return reached
        count = grown
        second = jumps.select("path", F.col("start").alias("following"), F.col("following").alias("landing"))
        jumps = written(
            jumps.join(second.hint("merge"), ["path", "following"]).select("path", "start", F.col("landing").alias("following")),
            "warc-links",
        )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record: ``record_type``, ``record_id``, ``refers_to``, ``target_uri``, ``payload_digest`` and
    ``payload_length`` as the header says, and ``block``, the bytes of the record.

    Payloads stay where they are; only pieces that are not a whole record by themselves are looked up and joined.
    """
    pieces = pieces_of(spark, folder)
    found = written(candidates(pieces), "warc-candidates")
    good = reachable(found.filter("start >= 0").select("path", "start", "following")).withColumn("good", F.lit(True))
    found = found.join(good.hint("merge"), ["path", "start"], "left")
    odd = found.filter("start < 0 OR good IS NULL OR NOT whole").select("n", "start", F.coalesce("good", F.lit(False)).alias("good"))
    odd = sized(written(odd, "warc-odd"))
    records = parsed(pieces.join(odd.select("n"), "n", "left_anti"))
    # A magic line inside a payload parts it: the pieces go back to the last record that starts before them.
    broken = parsed(pieces.join(odd, "n")).filter("start >= 0")
    last = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    broken = broken.withColumn("owner", F.last(F.when(F.col("good"), F.col("start")), ignorenulls=True).over(last))
    parts = F.array_sort(F.collect_list(F.struct("start", "value")))
    mended = broken.groupBy("path", "owner").agg(
        *[F.max(F.when(F.col("good"), F.col(name))).alias(name) for name in ("head", "body", "length")],
        F.array_join(F.transform(parts, lambda p: p.value), MAGIC).alias("value"),
    )
    names = ["head", "body", "length", "value"]
    records = records.select(*names).unionByName(mended.filter("owner IS NOT NULL").select(*names))
    block = F.substring(F.col("value").cast("binary"), F.col("body").cast("int") + 1, F.col("length").cast("int"))
    return records.select(
        _field(F.col("head"), "WARC-Type").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("head"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("payload_digest"),
        _field(F.col("head"), "X-Payload-Length").cast("long").alias("payload_length"),
        block.alias("block"),
    )


def page_of(record_id: Column) -> Column:
    """The page a record id names."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def through_archive(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Write all pages into an archive of their own in the shared folder and read it back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    write_archive(pages, folder, least_revisit)
    return read_archive(pages.sparkSession, folder)
