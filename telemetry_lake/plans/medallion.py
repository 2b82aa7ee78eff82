"""Raw to Bronze to Silver to Gold in one run, and refreshes of the days that new batches touched."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.operators.refine import to_gold, to_silver
from telemetry_lake.schema import DAY_COLUMNS
from telemetry_lake.sinks.files import drop_silver_days, replace_gold_days, write_gold, write_silver
from telemetry_lake.sources.bronze import Bronze
from telemetry_lake.sources.landing import days_from, on_days, read_bronze, read_gold, read_silver
from telemetry_lake.sources.tables import check_format, drop_old_versions, overwrite_table, read_table
from telemetry_lake.streaming.ingest import ingest_bronze

SETTINGS = T.StructType([T.StructField("dedupe", T.BooleanType())])


def _layers(lake: str) -> tuple[str, str, str]:
    return tuple(f"{lake.rstrip('/')}/{layer}" for layer in ("bronze", "silver", "gold"))


def refine_lake(
    spark: SparkSession,
    raw: str,
    lake: str,
    fmt: str = "parquet",
    max_files: int = 500,
    dedupe: bool = False,
    compact: bool = True,
    checked: bool = False,
) -> DataFrame:
    """Ingest new landing files and rebuild Silver and Gold below ``lake``; returns Gold.

    ``fmt`` is the format of Bronze and Gold; Silver is always partitioned Parquet. ``dedupe`` is recorded in the lake
    and holds for later refreshes.
    """
    check_format(fmt)
    bronze, silver, gold = _layers(lake)
    ingest_bronze(spark, raw, bronze, f"{lake.rstrip('/')}/checkpoints/bronze", fmt, max_files, checked)
    seen = Bronze(spark, bronze).pending() if fmt == "parquet" else None
    settings = f"{lake.rstrip('/')}/settings"
    overwrite_table(spark.createDataFrame([(dedupe,)], SETTINGS), settings)
    drop_old_versions(spark, settings)
    write_silver(to_silver(read_bronze(spark, bronze, fmt), dedupe), silver, compact=compact)
    write_gold(to_gold(read_silver(spark, silver)), gold, fmt)
    if seen is not None:
        Bronze(spark, bronze).fold(seen)
    return read_gold(spark, gold, fmt)


def refresh_touched_days(
    spark: SparkSession, raw: str, lake: str, max_files: int = 500, dedupe: bool | None = None, checked: bool = False
) -> DataFrame:
    """Ingest new landing files, and rebuild Silver and Gold of the days that they hold rows of; returns Gold.

    The days come from the entries of the batches taken in since the last refresh, rows without a readable time being a
    day of their own. Bronze is read from the batches that hold rows of these days, Silver and Gold are replaced
    day by day. A refresh that fails leaves its batches pending, and the next one does their days again.
    """
    bronze, _, gold = _layers(lake)
    ingest_bronze(spark, raw, bronze, f"{lake.rstrip('/')}/checkpoints/bronze", "parquet", max_files, checked)
    layer = Bronze(spark, bronze)
    seen = layer.pending()
    triples = seen.filter("rows > 0").select(*DAY_COLUMNS).distinct().collect()
    days = [None if row.year is None else date(row.year, row.month, row.day) for row in triples]
    if days:
        _rebuild(spark, layer.rows_touching(days), lake, days, dedupe, "parquet")
    layer.fold(seen)
    return read_gold(spark, gold)


def refresh_days(
    spark: SparkSession,
    bronze_rows: DataFrame | None,
    lake: str,
    first_day: str,
    last_day: str,
    fmt: str = "parquet",
    dedupe: bool | None = None,
) -> DataFrame:
    """Rebuild the Silver days from ``first_day`` to ``last_day`` and replace these days in Gold.

    ``bronze_rows`` must hold all rows of these days; None takes the batches of Bronze that do. Rows of other
    days, and rows without a readable time, are left to a refresh of their own: their Silver and
    Gold stay as they are. A source that has no rows on a day any more loses its total of that day, and a day without
    rows vanishes. ``dedupe`` is that of the lake unless it is given.
    """
    bronze, _, gold = _layers(lake)
    days = days_from(first_day, last_day)
    rows = bronze_rows
    if rows is None:
        rows = Bronze(spark, bronze).rows_touching(days) if fmt == "parquet" else read_bronze(spark, bronze, fmt)
    _rebuild(spark, rows, lake, days, dedupe, fmt)
    return read_gold(spark, gold, fmt)


def _rebuild(
    spark: SparkSession, rows: DataFrame, lake: str, days: Iterable[date | None], dedupe: bool | None, fmt: str
) -> None:
    """Replace these days of Silver and Gold by what ``rows`` hold of them.

    Copies of an event are looked for among all of ``rows``: a repeated upload carries the time of the event, so
    its batch is read for the same day.
    """
    _, silver, gold = _layers(lake)
    days = list(days)
    if dedupe is None:
        known = read_table(spark, f"{lake.rstrip('/')}/settings", schema=SETTINGS).first()
        dedupe = bool(known and known.dedupe)
    fresh = to_silver(rows, dedupe).filter(on_days(days))
    written = Observation("days")
    fresh = fresh.observe(written, F.collect_set(F.when(F.col("year").isNotNull(), F.struct(*DAY_COLUMNS))).alias("days"))
    write_silver(fresh, silver, mode="dynamic")
    filled = {date(day["year"], day["month"], day["day"]) for day in written.get.get("days") or []}
    drop_silver_days(spark, silver, [day for day in days if day and day not in filled])
    replace_gold_days(to_gold(read_silver(spark, silver).filter(on_days(days))), gold, days, fmt)
