"""URL filters: nested rules found by a sort-merge range join over reversed-host keys.

A host is turned around label by label (``blog.example.org`` to ``org.example.blog.``), so that a host and all its
subdomains are one interval of keys. Intervals of different hosts are nested or apart. The rules' interval ends cut
the key line into segments; each segment has the stack of rule hosts that are open in it. Urls and segment starts
are sorted together by range, every url takes the stack of the last segment start before it, and the longest
rule of the stack whose path fits decides.

The sorted sweep is split into the partitions of the range sort: each takes over the last stack of the
partitions before it, so no task sees more than its own range. Equal keys are parted by page id, hence a
host that holds most pages is spread as well. Only DataFrame functions.

Defined results: a NULL url or one without ``://`` has an empty host and path and gets the default verdict;
repeated rows are judged alike; of fitting rules the one with more characters wins, among those the longer host;
of two rules with the same host and path the later one replaces the earlier. Very long urls are keys like any other;
empty tables stay empty. Other columns of the pages are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.common import lower_ascii, written

# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
STACK = "array<struct<size:int,host:int,path:string,rule:string,verdict:string>>"


def host_and_path(url) -> tuple:
    """Host, A-Z lower-cased, and path of a url column."""
    # One pattern for both: what follows the first ``://``, up to the mark that ends host or path.
    found = lambda group: F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit("")
    )
    return lower_ascii(found(1)), found(2)


def reversed_host(host):
    """Labels from the last to the first, each followed by a dot; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def segments(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, list[tuple]]]:
    """Starts of the segments, in order, each with the rules that are open from there on.

    The interval of a host goes from its key to the key with the last dot raised by one.
    """
    by_key: dict[str, dict[str, tuple]] = {}
    for verdict, host, path in rules:
        host = host.lower()
        key = ".".join(reversed(host.split("."))) + "."
        rule = (len(host) + len(path), len(host), path, host + path, verdict)
        by_key.setdefault(key, {})[path] = rule
    out: list[tuple[str, list[tuple]]] = [("", [])]
    stack: list[tuple[str, list[tuple]]] = []  # key and rules of the open hosts, outermost first

    def close(upto: str | None) -> None:
        while stack and (upto is None or not upto.startswith(stack[-1][0])):
            end = stack.pop()[0][:-1] + "/"
            out.append((end, [rule for _, own in stack for rule in own]))

    for key in sorted(by_key, key=lambda k: k.encode()):
        close(key)
        stack.append((key, list(by_key[key].values())))
        out.append((key, [rule for _, own in stack for rule in own]))
    close(None)
    # Of several segments with one start the last is the one that holds.
    return list({start: rules for start, rules in out}.items())


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow",
    url: str = "url", key: str = "page_id",
) -> DataFrame:
    """``(key, host, path, rule, verdict)`` for each row. ``rules`` is a list of the caller's."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(key).alias("_id"), host.alias("host"), path.alias("path"))
    urls = urls.select("*", reversed_host(F.col("host")).alias("k"), F.lit(1).alias("kind"), F.lit(None).cast(STACK).alias("stack"))
    text = lambda value: F.lit(value).cast("string")
    marks = [
        F.struct(
            text(start).alias("k"),
            F.array(*[
                F.struct(F.lit(a).alias("size"), F.lit(b).alias("host"), text(c).alias("path"),
                         text(d).alias("rule"), text(e).alias("verdict"))
                for a, b, c, d, e in own
            ]).cast(STACK).alias("stack"),
        )
        for start, own in segments(rules)
    ]
    starts = spark.range(1).select(F.inline(F.array(*marks)))
    starts = starts.select(
        F.lit(None).cast(urls.schema["_id"].dataType).alias("_id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), "k", F.lit(0).alias("kind"), "stack",
    )
    # The range sort is written, so that partition numbers and order are the same for every later reader.
    line = urls.unionByName(starts).repartitionByRange("k", "kind", "_id").sortWithinPartitions("k", "kind", "_id")
    line = written(line.withColumn("part", F.spark_partition_id()), "url-line")
    # The last stack of each partition that has one, handed on to the partitions after it: one row a partition.
    ends = line.filter("kind = 0").groupBy("part").agg(F.max_by("stack", "k").alias("end"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = line.groupBy("part").agg(F.count("*").alias("n")).join(ends, "part", "left")
    parts = parts.select("part", F.last("end", ignorenulls=True).over(order).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("k", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    swept = swept.join(F.broadcast(parts), "part").withColumn("open", F.coalesce("open", "carried"))
    fitting = F.filter("open", lambda r: F.col("path").startswith(r.path))
    best = F.array_max(fitting)
    return swept.select(
        F.col("_id").alias(key), "host", "path", best.rule.alias("rule"),
        F.coalesce(best.verdict, F.lit(default)).alias("verdict"),
    )
