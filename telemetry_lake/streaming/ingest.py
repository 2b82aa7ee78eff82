"""Incremental ingestion: queue to landing files, landing files to Bronze."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.operators.validate import check_records
from telemetry_lake.schema import BRONZE, CORRUPT, LANDING, TELEMETRY
from telemetry_lake.sinks.files import LANDING_DELAY, LANDING_ROWS
from telemetry_lake.sources.bronze import INGEST_DATE, Bronze
from telemetry_lake.sources.landing import read_raw, with_source_file
from telemetry_lake.sources.tables import check_format
from telemetry_lake.streaming.runner import run_available

# Landing folder written by the validating sink: rejects lie beside the valid records.
CHECKED_LANDING = T.StructType(
    [
        *LANDING.fields,
        T.StructField("reject_reasons", T.ArrayType(T.StringType())),
        T.StructField("raw", T.StringType()),
        T.StructField("valid", T.BooleanType()),
    ]
)


def start_landing(
    values: DataFrame,
    path: str,
    checkpoint: str,
    value_col: str = "value",
    mode: str = "lax",
    max_records: int = LANDING_ROWS,
    delay: str | None = LANDING_DELAY,
) -> StreamingQuery:
    """Validate a text stream into gzip JSON-lines files, one pass over each record.

    Valid records go to ``valid=true``, rejects with their text and reasons to ``valid=false``.
    The file sink's log makes each micro-batch appear once, and source offsets advance only
    after it is written; a failed write stops the query. ``delay`` is the longest a micro-batch
    waits (a Kafka source adds a row count, see ``kafka_options``); ``None`` drains and stops.
    """
    checked = check_records(values, value_col, mode)
    reasons = F.when(~F.col("valid"), F.col("reject_reasons"))
    writer = (
        checked.withColumn("reject_reasons", reasons)
        .writeStream.format("json")
        .outputMode("append")
        .partitionBy("valid")
        .options(compression="gzip", maxRecordsPerFile=max_records, checkpointLocation=checkpoint)
    )
    writer = writer.trigger(processingTime=delay) if delay else writer.trigger(availableNow=True)
    return writer.start(path)


def read_checked(
    spark: SparkSession, path: str, valid: bool = True, streaming: bool = False, max_files: int = 500
) -> DataFrame:
    """Valid records, or the rejects, of a folder written by ``start_landing``."""
    rows = read_raw(spark, path, streaming, max_files, CHECKED_LANDING, partitioned=True).filter(F.col("valid") == valid)
    return rows.select(*LANDING.fieldNames()) if valid else rows.select("raw", "reject_reasons")


def ingest_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files: int = 500,
    checked: bool = False,
    keeping: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append the landing files that are new since the last run, then stop.

    All fields are kept, with the text of corrupt lines and the file each row came from.
    ``checked`` says that ``raw`` was written by ``start_landing``. As Parquet, every micro-batch becomes a batch of
    Bronze with an entry of the days it touched (see ``sources.bronze``); one that is run again after a failure
    replaces itself, or finds its entry and is done. ``keeping`` is what becomes of files that were read.
    """
    schema = CHECKED_LANDING if checked else LANDING
    rows = read_raw(spark, raw, True, max_files, schema, keeping, checked)
    rows = with_source_file(rows.filter("valid") if checked else rows)
    if check_format(fmt) == "delta":
        return run_available(rows.select(*BRONZE.fieldNames()), bronze, checkpoint, fmt)
    layer = Bronze(spark, bronze)
    newest, epochs = layer.last()
    state = {"newest": newest}

    def store(batch: DataFrame, epoch: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if epoch > epochs.get(query, -1):
            layer.append(batch, state["newest"] + 1, query, epoch)
            state["newest"] += 1

    landed = F.to_date("_metadata.file_modification_time").alias(INGEST_DATE)
    writer = rows.select(*BRONZE.fieldNames(), landed).writeStream.foreachBatch(store)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stored_records(bronze: DataFrame) -> DataFrame:
    """Bronze rows that were JSON, without the bookkeeping columns."""
    return bronze.filter(F.col(CORRUPT).isNull()).select(*TELEMETRY.fieldNames())
