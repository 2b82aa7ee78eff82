"""Alert delivery from micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.operators.throttle import LOCKS, new_locks, throttle_batch
from telemetry_lake.schema import THROTTLE_SECONDS
from telemetry_lake.sinks.outbox import to_outbox
from telemetry_lake.sources.files import committed
from telemetry_lake.sources.tables import drop_old_versions, merged, overwrite_table, read_table


def alert_sink(
    deliver: Callable[[str], bool],
    outbox: str,
    locks: str,
    clock: str = "window_end",
    seconds: int = THROTTLE_SECONDS,
    query: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: throttle, deliver, record, lock.

    Attempts of a micro-batch are written to ``<outbox>/query=<id>/batch=<id>`` as they are made, and
    locks are derived from that record. A micro-batch run again after a failure finds its record and
    delivers nothing twice; only a failure in the middle of delivering can repeat a post. The query
    is the streaming query's own id, which changes with the checkpoint, unless ``query`` names one. Outside
    of a stream it has to: batches numbered by hand are told apart by nothing else.
    Locks that have run out before the newest clock are left out when the lock table is rewritten.
    """

    def handle(alerts: DataFrame, batch_id: int) -> None:
        spark = alerts.sparkSession
        owner = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not owner:
            raise ValueError("outside of a stream, name the query whose batches these are")
        record = f"{outbox.rstrip('/')}/query={owner}/batch={batch_id}"
        if not committed(spark, record):
            if alerts.isEmpty():
                return
            held = read_table(spark, locks, schema=LOCKS)
            attempts = throttle_batch(held, to_outbox(alerts).drop("status"), deliver, clock, seconds)
            attempts.write.mode("overwrite").parquet(record)
        fresh = new_locks(spark.read.parquet(record), clock)
        if not fresh.isEmpty():
            held = merged(read_table(spark, locks, schema=LOCKS), fresh, ["src_ip"])
            newest = fresh.agg(F.max("fired_at")).first()[0]
            running = F.unix_micros("fired_at") > F.unix_micros(F.lit(newest)) - seconds * 1_000_000
            overwrite_table(held.filter(running), locks)
            drop_old_versions(spark, locks)

    return handle
