"""Running streaming queries to completion, and replaying a bounded input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.session import scratch_dir

# Whether Spark checks late rows against the watermark of the previous batch (true) or of the
# current one (false). A query with a single stateful operator may use the stricter form.
_CHAINED_STATE = "spark.sql.streaming.statefulOperator.allowMultiple"


@contextmanager
def exact_lateness(spark: SparkSession) -> Iterator[None]:
    """Start queries that drop late rows without the usual lag of one micro-batch.

    Only for queries with one stateful operator, and fixed for the life of a checkpoint.
    """
    before = spark.conf.get(_CHAINED_STATE)
    spark.conf.set(_CHAINED_STATE, "false")
    try:
        yield
    finally:
        spark.conf.set(_CHAINED_STATE, before)


def run_available(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    **options,
) -> StreamingQuery:
    """Append everything available now to ``path``, then stop. Progress stays in ``checkpoint``."""
    writer = df.writeStream.format(fmt).outputMode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


LATE_ROWS = "query string, batch bigint, rows_in bigint, late_rows bigint, watermark string"
# Progress entries a query keeps, enough for every micro-batch of a catch-up run.
_PROGRESS_KEPT = ("spark.sql.streaming.numRecentProgressUpdates", "100000")


def run_counting_late_rows(
    df: DataFrame, path: str, checkpoint: str, log: str, fmt: str = "parquet", **options
) -> StreamingQuery:
    """``run_available``, and a table beside the output of how many late rows each micro-batch turned away.

    The counts are those of the stateful operators' watermark filters, taken from the progress of the run. They are
    written as ``<log>/run=<id>``, so a run that is started again adds its own micro-batches only. Windows and other
    partial sums count a late row once per group it would have been part of; de-duplication counts rows.
    """
    spark = df.sparkSession
    name, kept = _PROGRESS_KEPT
    before = spark.conf.get(name, "100")
    spark.conf.set(name, kept)
    try:
        query = run_available(df, path, checkpoint, fmt, **options)
    finally:
        spark.conf.set(name, before)
    rows = [
        (str(query.id), p["batchId"], p["numInputRows"], dropped_late(p), p["eventTime"].get("watermark"))
        for p in query.recentProgress
    ]
    spark.createDataFrame(rows, LATE_ROWS).coalesce(1).write.mode("overwrite").parquet(f"{log}/run={query.runId}")
    return query


def dropped_late(progress) -> int:
    return sum(operator.get("numRowsDroppedByWatermark", 0) for operator in progress["stateOperators"])


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark has turned away in the progress kept for ``query``."""
    return sum(dropped_late(progress) for progress in query.recentProgress)


def replay(
    source: DataFrame,
    closing_row: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    purpose: str,
    exact: bool = False,
) -> DataFrame:
    """Run a windowed stream over a bounded source and close its windows.

    A window is emitted once the watermark passes its end, so the last ones wait for a later
    event. The first run takes the source; ``closing_row``, one event far in the future, then
    arrives on a second path, and a second run on the same checkpoint emits the rest. The
    window holding the closing row itself stays open.
    """
    spark = source.sparkSession
    base = scratch_dir(spark, purpose)
    tail, out = f"{base}/tail", f"{base}/out"
    closing_row.limit(0).write.parquet(tail)
    result = build(source.unionByName(spark.readStream.schema(source.schema).parquet(tail)))

    def run() -> None:
        if exact:
            with exact_lateness(spark):
                run_available(result, out, f"{base}/checkpoint")
        else:
            run_available(result, out, f"{base}/checkpoint")

    run()
    closing_row.write.mode("append").parquet(tail)
    run()
    return spark.read.schema(result.schema).parquet(out)
