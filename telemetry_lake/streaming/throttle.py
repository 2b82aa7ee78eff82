"""Throttling inside a stream: the last firing time of each source is state, and so are alerts that wait for order."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from telemetry_lake.operators.throttle import chain
from telemetry_lake.schema import THROTTLE_SECONDS

# Spark renames columns with a leading underscore on their way to these processors.
_CLOCK = "throttle_clock_us"


def _sent(rows: pd.DataFrame, hold: int, fired: int | None) -> tuple[pd.DataFrame, int | None]:
    """The rows that are sent, in time order, and the last firing time after them."""
    clocks = rows[_CLOCK].to_numpy(np.int64)
    order = np.argsort(clocks, kind="stable")
    attempted, fired = chain(clocks[order], np.ones(len(clocks), bool), hold, fired)
    return rows.iloc[order[attempted]], fired


def _throttle_processor(seconds: int) -> StatefulProcessor:
    # Defined here so that it travels to the executors by value.
    class KeepOnePerLock(StatefulProcessor):
        def init(self, handle) -> None:
            self.fired = handle.getValueState("fired", "at long")

        def handleInputRows(self, key, rows, timerValues):
            last = self.fired.get()
            before = last[0] if last else None
            sent, fired = _sent(pd.concat(list(rows)), seconds * 1_000_000, before)
            if fired != before:
                self.fired.update((fired,))
            yield sent

        def close(self) -> None:
            pass

    return KeepOnePerLock()


def _ordered_processor(seconds: int, columns: list[str]) -> StatefulProcessor:
    """Alerts wait until the watermark has passed them; a timer at the earliest one's clock wakes the source."""

    class WaitForOrder(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.fired = handle.getValueState("fired", "at long")
            self.waiting = handle.getListState("waiting", "clock long, alert binary")

        def handleInputRows(self, key, rows, timerValues):
            for chunk in rows:
                clocks = chunk[_CLOCK].tolist()
                alerts = [pickle.dumps(row) for row in chunk.itertuples(index=False, name=None)]
                self.waiting.appendList(list(zip(clocks, alerts, strict=True)))
                self._wake(min(clocks))
            yield pd.DataFrame(columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            waiting = list(self.waiting.get()) if self.waiting.exists() else []
            due = [alert for clock, alert in waiting if clock <= passed]
            later = [(clock, alert) for clock, alert in waiting if clock > passed]
            if due:
                before = self.fired.get()[0] if self.fired.exists() else None
                sent, fired = _sent(pd.DataFrame.from_records([pickle.loads(alert) for alert in due], columns=columns), seconds * 1_000_000, before)
                if fired != before:
                    self.fired.update((fired,))
                if later:
                    self.waiting.put(later)
                    self._wake(min(clock for clock, _ in later))
                else:
                    self.waiting.clear()
                yield sent
            else:
                yield pd.DataFrame(columns=columns)

        def _wake(self, clock: int) -> None:
            self.handle.registerTimer(-(-clock // 1000))

        def close(self) -> None:
            pass

    return WaitForOrder()


def throttle_stream(
    alerts: DataFrame,
    clock: str = "window_end",
    seconds: int = THROTTLE_SECONDS,
    key: str = "src_ip",
    lateness: str | None = None,
) -> DataFrame:
    """The streaming form of ``throttle``: the last firing time of each source is kept as state.

    A micro-batch's alerts of a source are put in time order and sent at once, which is right where micro-batches
    bring them in order, as closed windows do. With ``lateness`` alerts may come in any order within that time: they wait
    in state until an event-time timer finds that the watermark has passed them, and later ones are dropped. Alerts without
    a clock are not sent. Needs the RocksDB state store.
    """
    timed = alerts.withColumn(_CLOCK, F.unix_micros(clock)).filter(F.col(_CLOCK).isNotNull())
    if lateness is None:
        processor, mode = _throttle_processor(seconds), "none"
    else:
        timed = timed.withWatermark(clock, lateness)
        processor, mode = _ordered_processor(seconds, timed.columns), "eventTime"
    fired = timed.groupBy(key).transformWithStateInPandas(processor, timed.schema, "append", mode)
    return fired.drop(_CLOCK)
