"""Bronze in batches, and which days each batch touched.

``<bronze>/ingest_date=<day>/batch=<n>`` holds the rows a micro-batch took in, by the day their landing file was
written. ``<bronze>-days`` says for every batch how many rows of which event days it holds: ``pending/batch=<n>`` for
batches no refresh has seen yet, ``folded`` for all others. A batch counts once its entry there is committed, so half a
batch is never read, and the refresh of a day opens only the batches that hold rows of it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.time import date_parts, event_timestamp
from telemetry_lake.schema import BRONZE, DAY_COLUMNS
from telemetry_lake.sources.files import delete, found
from telemetry_lake.sources.landing import on_days
from telemetry_lake.sources.tables import drop_old_versions, overwrite_table, read_table

BATCH, INGEST_DATE = "batch", "ingest_date"
STORED = T.StructType([*BRONZE.fields, T.StructField(INGEST_DATE, T.DateType()), T.StructField(BATCH, T.IntegerType())])
TOUCHED = T.StructType([
    T.StructField(BATCH, T.IntegerType()),
    T.StructField(INGEST_DATE, T.DateType()),
    *[T.StructField(name, T.IntegerType()) for name in DAY_COLUMNS],
    T.StructField("rows", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("epoch", T.LongType()),
])


@dataclass(frozen=True)
class Bronze:
    """A Bronze layer and its manifest."""

    spark: SparkSession
    path: str

    @property
    def _days(self) -> str:
        return f"{self.path.rstrip('/')}-days"

    def _entries(self) -> list[str]:
        marks = found(self.spark, f"{self._days}/pending/{BATCH}=*/_SUCCESS")
        return [mark.rsplit("/", 1)[0] for mark in marks]

    def pending(self) -> DataFrame:
        """Days that batches touched since the last refresh."""
        entries = self._entries()
        reader = self.spark.read.schema(TOUCHED).option("basePath", f"{self._days}/pending")
        return reader.parquet(*entries) if entries else self.spark.createDataFrame([], TOUCHED)

    def touched(self) -> DataFrame:
        """Days that any batch touched, as rows ``(batch, ingest_date, year, month, day, rows, query, epoch)``."""
        return read_table(self.spark, f"{self._days}/folded", schema=TOUCHED).unionByName(self.pending()).distinct()

    def last(self) -> tuple[int, dict[str, int]]:
        """The newest batch, and the newest epoch of each query that wrote one."""
        seen = self.touched().groupBy("query").agg(F.max(BATCH).alias(BATCH), F.max("epoch").alias("epoch")).collect()
        return max((row[BATCH] for row in seen), default=-1), {row["query"]: row["epoch"] for row in seen}

    def append(self, rows: DataFrame, batch: int, query: str, epoch: int) -> None:
        """Write a batch and then its entry. A repeated attempt replaces what the one before left."""
        stored = rows.withColumn(BATCH, F.lit(batch))
        writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(INGEST_DATE, BATCH).parquet(self.path)
        own = self._stored().filter(F.col(BATCH) == batch).filter("src_ip IS NOT NULL AND bytes_sent IS NOT NULL")
        days = own.withColumns(date_parts(event_timestamp(F.col("timestamp"))))
        counts = days.groupBy(INGEST_DATE, *DAY_COLUMNS).agg(F.count("*").alias("rows"))
        # A batch without rows for Silver still is one.
        marked = counts.unionByName(self.spark.range(1).select(F.lit(0).cast("long").alias("rows")), allowMissingColumns=True)
        entry = marked.withColumns({"query": F.lit(query), "epoch": F.lit(epoch).cast("long")}).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self._days}/pending/{BATCH}={batch}")

    def _stored(self) -> DataFrame:
        if not found(self.spark, f"{self.path.rstrip('/')}/*"):
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(self.path)

    def rows(self) -> DataFrame:
        """All rows of committed batches."""
        return self._stored().filter(F.col(BATCH) <= self.last()[0])

    def rows_touching(self, days: Iterable[date | None]) -> DataFrame:
        """Rows of the batches that hold rows of these days; files of other batches are not opened.

        The number of batches and ingest dates a day is spread over is what its late rows make it.
        """
        holds = self.touched().filter("rows > 0").filter(on_days(days)).select(BATCH, INGEST_DATE).distinct().collect()
        batches, dates = ({row[name] for row in holds} for name in (BATCH, INGEST_DATE))
        stored = self._stored().filter(F.col(BATCH).isin(sorted(batches)))
        return stored.filter(F.col(INGEST_DATE).isin(sorted(dates)))

    def fold(self, entries: DataFrame) -> None:
        """Count these pending entries, read before the refresh, among those that a refresh has seen."""
        batches = [row[BATCH] for row in entries.select(BATCH).distinct().collect()]
        if not batches:
            return
        folder = f"{self._days}/folded"
        before = read_table(self.spark, folder, schema=TOUCHED)
        overwrite_table(before.unionByName(entries.select(*TOUCHED.fieldNames())).distinct().coalesce(1), folder)
        for batch in batches:
            delete(self.spark, f"{self._days}/pending/{BATCH}={batch}")
        drop_old_versions(self.spark, folder)


def has_batches(spark: SparkSession, path: str) -> bool:
    return bool(found(spark, f"{path.rstrip('/')}-days/*"))
