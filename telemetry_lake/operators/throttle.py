"""Alert throttling: one delivery per source until the lock runs out."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.schema import THROTTLE_SECONDS

LOCKS = T.StructType(
    [T.StructField("src_ip", T.StringType()), T.StructField("fired_at", T.TimestampType())]
)

_CLOCK, _OK = "_clock_us", "_ok"


def throttle(
    alerts: DataFrame,
    clock: str = "window_end",
    seconds: int = THROTTLE_SECONDS,
    key: str = "src_ip",
    delivered: str | None = None,
) -> DataFrame:
    """The alerts that are sent: first of a source, then each one ``seconds`` or more after the
    last that locked. With a ``delivered`` column, a failed attempt is sent but does not lock.
    """
    succeeded = F.lit(True) if delivered is None else F.coalesce(F.col(delivered), F.lit(False))
    tagged = alerts.withColumn(_OK, succeeded)
    return _attempts(tagged, clock, seconds, key, None).drop(_OK)


def throttle_batch(
    locks: DataFrame,
    alerts: DataFrame,
    deliver: Callable[[str], bool],
    clock: str = "window_end",
    seconds: int = THROTTLE_SECONDS,
    payload: str = "payload",
) -> DataFrame:
    """Deliver what the lock table lets through; every attempt comes back with ``delivered``.

    ``deliver`` takes the payload on an executor and tells whether it was accepted. If it has
    ``open`` or ``close``, they are called once per task, around its deliveries. The result is
    lazy, and each evaluation delivers: write it once and read the written rows.
    """
    free = unlocked(alerts, locks, clock, seconds)
    tagged = free.withColumn(_OK, F.lit(False))
    return _attempts(tagged, clock, seconds, "src_ip", (payload, deliver)).withColumnRenamed(_OK, "delivered")


def unlocked(
    alerts: DataFrame, locks: DataFrame, clock: str = "window_end", seconds: int = THROTTLE_SECONDS
) -> DataFrame:
    """Alerts of sources without a running lock (an anti-join on the lock table)."""
    a, k = alerts.alias("a"), locks.alias("k")
    age = F.unix_micros(f"a.{clock}") - F.unix_micros("k.fired_at")
    held = (F.col("a.src_ip") == F.col("k.src_ip")) & (age < seconds * 1_000_000)
    return a.join(k, held, "left_anti")


def new_locks(attempts: DataFrame, clock: str = "window_end") -> DataFrame:
    """The lock each source holds after its accepted deliveries."""
    done = attempts.filter("delivered")
    return done.groupBy("src_ip").agg(F.max(clock).cast("timestamp").alias("fired_at"))


def chain(clocks: np.ndarray, ok: np.ndarray, hold: int, fired: int | None) -> tuple[np.ndarray, int | None]:
    """Which of one source's alerts are attempted, and the clock that locks after them.

    ``clocks`` ascend; ``ok`` says which deliveries succeed; ``fired`` is the clock of the last success before. From a
    success the walk jumps to the end of its lock by binary search, from a failure to the next success.
    """
    attempted = np.zeros(len(clocks), bool)
    successes = np.flatnonzero(ok)
    i = 0 if fired is None else int(np.searchsorted(clocks, fired + hold))
    while i < len(clocks):
        k = int(np.searchsorted(successes, i))
        if k == len(successes):
            attempted[i:] = True
            break
        last = int(successes[k])
        attempted[i : last + 1] = True
        fired = int(clocks[last])
        i = int(np.searchsorted(clocks, fired + hold))
    return attempted, fired


def _delivered(
    clocks: np.ndarray, texts: pa.Array, deliver: Callable[[str], bool], hold: int, fired: int | None
) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Deliver what one source's chain lets through: which were attempted, which were accepted, the locking clock."""
    attempted, ok = np.zeros(len(clocks), bool), np.zeros(len(clocks), bool)
    i = 0 if fired is None else int(np.searchsorted(clocks, fired + hold))
    while i < len(clocks):
        attempted[i] = True
        ok[i] = bool(deliver(texts[i].as_py()))
        if ok[i]:
            fired = int(clocks[i])
            i = int(np.searchsorted(clocks, fired + hold))
        else:
            i += 1
    return attempted, ok, fired


def _attempts(alerts: DataFrame, clock: str, seconds: int, key: str, sender) -> DataFrame:
    """Walk each source's alerts in time order and keep the attempts; alerts without a clock are none.

    Whether an alert is sent depends on the one sent before it, which no join or window frame
    expresses. Spark clusters and sorts the alerts; the walk takes the sorted batches one after the other, jumps
    from sent alert to sent alert, and remembers one number between batches, so a source with any number of alerts
    takes constant memory.
    """
    ordered = alerts.withColumn(_CLOCK, F.unix_micros(clock)).filter(F.col(_CLOCK).isNotNull())
    ties = [f.name for f in alerts.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name != key]
    ordered = ordered.repartition(key).sortWithinPartitions(key, _CLOCK, *ties)
    hold = seconds * 1_000_000

    def _nothing() -> None:
        pass

    def walk(batches):
        if not sender:
            yield from step(batches)
            return
        getattr(sender[1], "open", _nothing)()
        try:
            yield from step(batches)
        finally:
            getattr(sender[1], "close", _nothing)()

    def step(batches):
        current, fired = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            keys, clocks = batch.column(names.index(key)), batch.column(names.index(_CLOCK)).to_numpy()
            ok = batch.column(names.index(_OK)).to_numpy(zero_copy_only=False).copy()
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            keep = np.zeros(len(codes), bool)
            for a, b in zip(edges, edges[1:], strict=False):
                own = keys[a].as_py()
                if a or own != current:
                    current, fired = own, None
                if sender:
                    texts = batch.column(names.index(sender[0])).slice(a, b - a)
                    keep[a:b], ok[a:b], fired = _delivered(clocks[a:b], texts, sender[1], hold, fired)
                else:
                    keep[a:b], fired = chain(clocks[a:b], ok[a:b], hold, fired)
            position = names.index(_OK)
            batch = batch.set_column(position, batch.schema.field(position), pa.array(ok, pa.bool_()))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return ordered.mapInArrow(walk, ordered.schema).drop(_CLOCK)
