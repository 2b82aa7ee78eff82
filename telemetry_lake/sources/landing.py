"""File sources: raw landing files and the refined layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.schema import CORRUPT, LANDING, SOURCE_FILE
from telemetry_lake.sources.buckets import snapshot
from telemetry_lake.sources.tables import read_table


def housekeeping(archive: str | None = None, delete: bool = False, max_age: str | None = None) -> dict[str, str]:
    """Options that keep the file list of a landing stream bounded.

    Files of completed micro-batches move to ``archive``, a folder outside of the landing one, or are deleted; a
    micro-batch's files go when the next one begins. ``max_age`` (such as ``7d``), counted from the newest file, is how
    late a file may land; older ones are ignored, and forgotten by the stream.
    """
    if archive and delete:
        raise ValueError("files are archived or deleted, not both")
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    if delete:
        options = {"cleanSource": "delete"}
    return {**options, **({"maxFileAge": max_age} if max_age else {})}


def landing_folder(path: str, at: datetime) -> str:
    """The folder for files that land in this hour, ``<path>/date=<day>/hour=<hour>``."""
    return f"{path.rstrip('/')}/date={at:%Y-%m-%d}/hour={at:%H}"


def read_raw(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files: int = 500,
    schema=LANDING,
    keeping: Mapping[str, str] | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """JSON-lines files, compressed or not, with a declared schema, also in folders by date and hour.

    As a stream, each micro-batch takes at most ``max_files`` new files, and ``keeping`` says what becomes of files
    that were read (see ``housekeeping``). The reader is permissive: a line that is not JSON becomes a row holding
    only ``_corrupt_record``. Names of folders are columns only if the files are ``partitioned``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).options(**(keeping or {})) if streaming else spark.read
    reader = reader.option("recursiveFileLookup", not partitioned)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return reader.schema(schema).options(**options).json(path)


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All rows of Bronze; of a layer in batches those that are committed, with the batch and its ingest date."""
    from telemetry_lake.sources.bronze import Bronze, has_batches

    if fmt == "parquet" and has_batches(spark, path):
        return Bronze(spark, path).rows()
    return spark.read.format(fmt).load(path)


def read_silver(
    spark: SparkSession,
    path: str,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
) -> DataFrame:
    """Silver rows, restricted to whole days by partition pruning when bounds are given."""
    return between_days(spark.read.parquet(path), first_day, last_day)


def between_days(
    df: DataFrame, first_day: date | str | None = None, last_day: date | str | None = None
) -> DataFrame:
    """Keep days in ``[first_day, last_day]``.

    The predicate uses partition columns only, so files of other days are pruned before they are read;
    comparing the (year, month, day) triple keeps it free of date parsing.
    """
    triple = F.struct("year", "month", "day")
    if first_day is not None:
        df = df.filter(triple >= _day_triple(first_day))
    if last_day is not None:
        df = df.filter(triple <= _day_triple(last_day))
    return df.filter(F.col("year").isNotNull()) if first_day or last_day else df


def on_days(days: Iterable[date | None]) -> Column:
    """Whether a row is of one of these days, in terms of the partition columns; None is a row without a day."""
    days = set(days)
    whole = F.col("year").isNull() if None in days else F.lit(False)
    for (year, month), some in groupby(sorted(days - {None}), key=lambda day: (day.year, day.month)):
        inside = (F.col("year") == year) & (F.col("month") == month) & F.col("day").isin([day.day for day in some])
        whole = whole | F.coalesce(inside, F.lit(False))
    return whole


def day_bucket(day: date | None) -> str:
    """Name of a day's bucket in a table that is laid out by day."""
    return f"{day.year}-{day.month}-{day.day}" if day else "none-none-none"


def days_from(first_day: date | str, last_day: date | str) -> list[date]:
    """All days from the first to the last."""
    first, last = (date.fromisoformat(day) if isinstance(day, str) else day for day in (first_day, last_day))
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def _day_triple(day: date | str):
    day = date.fromisoformat(day) if isinstance(day, str) else day
    parts = {"year": day.year, "month": day.month, "day": day.day}
    return F.struct(*[F.lit(value).alias(name) for name, value in parts.items()])


def read_gold(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    first_day: date | str | None = None,
    last_day: date | str | None = None,
) -> DataFrame:
    """Gold rows. With bounds, only buckets of these days are opened, or files by their statistics."""
    state = snapshot(spark, path) if fmt == "parquet" else None
    if state is None or not (first_day or last_day):
        return between_days(read_table(spark, path, fmt), first_day, last_day)
    low, high = (date.fromisoformat(day) if isinstance(day, str) else day for day in (first_day, last_day))
    days = [_day_of(name) for name in state.folders]
    inside = [day_bucket(day) for day in days if day and (not low or day >= low) and (not high or day <= high)]
    return state.read(spark, path.rstrip("/"), inside)


def _day_of(bucket: str) -> date | None:
    parts = bucket.split("-")
    return date(*map(int, parts)) if len(parts) == 3 and all(part.isdigit() for part in parts) else None
