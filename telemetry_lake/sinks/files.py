"""File sinks: landing files, Silver and Gold."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.schema import DAY_COLUMNS, GOLD_KEYS
from telemetry_lake.sources.buckets import Layout, overwrite_buckets, replace_buckets, snapshot
from telemetry_lake.sources.files import delete, found
from telemetry_lake.sources.landing import day_bucket, on_days
from telemetry_lake.sources.tables import check_format, overwrite_table, read_table, upsert_table

GOLD_LAYOUT = Layout(tuple(GOLD_KEYS), tuple(DAY_COLUMNS))

# Rows per landing file and the longest a batch waits.
LANDING_ROWS = 2_000
LANDING_DELAY = "5 seconds"


def write_landing(df: DataFrame, path: str, max_records: int = LANDING_ROWS, mode: str = "append") -> None:
    """Gzip JSON-lines files of at most ``max_records`` rows; an empty frame writes none of them.

    The default suits many small producers. For large volumes raise it: gzip files cannot be
    split, so a file is a task, and a task should read some tens of megabytes.
    """
    options = {"compression": "gzip", "maxRecordsPerFile": max_records}
    df.write.mode(mode).options(**options).json(path)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite", compact: bool = True) -> None:
    """Parquet partitioned by day.

    ``overwrite`` replaces the table, ``dynamic`` only the days present in ``df``. ``compact``
    rebalances rows by day first: adaptive execution then merges small days and splits a large
    one over several tasks and files. Without it nothing is shuffled, which is right for input
    that already arrives in time order.
    """
    if mode not in ("overwrite", "dynamic"):
        raise ValueError(f"mode must be 'overwrite' or 'dynamic', not {mode!r}")
    rows = df.hint("rebalance", *DAY_COLUMNS) if compact else df
    overwrite = "dynamic" if mode == "dynamic" else "static"
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(*DAY_COLUMNS).parquet(path)


def drop_silver_days(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Delete the folders of these days, of which Silver has no rows any more."""
    for day in days:
        for folder in found(spark, f"{path.rstrip('/')}/year={day.year}/month={day.month}/day={day.day}"):
            delete(spark, folder)


def write_gold(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The whole Gold table; as Parquet it lies in one bucket per day."""
    if check_format(fmt) == "parquet":
        overwrite_buckets(df, path, GOLD_LAYOUT)
    else:
        overwrite_table(df, path, fmt)


def replace_gold_days(df: DataFrame, path: str, days: Iterable[date | None], fmt: str = "parquet") -> None:
    """Put ``df``, rows of some of these days, in the place of all Gold rows of these days.

    A day without rows vanishes. No other day of a Parquet table is read or written.
    """
    spark, days = df.sparkSession, list(days)
    if check_format(fmt) == "parquet":
        if snapshot(spark, path) is None:
            overwrite_buckets(df, path, GOLD_LAYOUT)
        else:
            replace_buckets(df, path, [day_bucket(day) for day in days])
        return
    overwrite_table(read_table(spark, path, fmt).filter(~on_days(days)).unionByName(df), path, fmt)


def upsert_gold(df: DataFrame, path: str, keys: list[str] = GOLD_KEYS, fmt: str = "parquet") -> None:
    """Insert or replace rows by key; only days that ``df`` has rows of are rewritten."""
    upsert_table(df, path, keys, fmt, by=DAY_COLUMNS if set(DAY_COLUMNS) <= set(keys) else ())
