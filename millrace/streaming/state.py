"""Totals by key in a state with timers: a key that is quiet gives its totals and goes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the state store that timers need; the caller's settings stay."""
    own = spark.newSession()
    own.conf.set(_STORE, _ROCKS)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


class QuietTotals(StatefulProcessor):
    """Count and sum by key, given once the event time has passed the key's last row by `quiet_ms`."""

    def __init__(self, key: str, quiet_ms: int):
        self.key, self.quiet_ms = key, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n bigint, total bigint, last_ms bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.totals.update((0, int(initialState["total"].sum()), 0))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, total, last = self.totals.get() if self.totals.exists() else (0, 0, 0)
        known = last
        for batch in rows:  # a hot key's rows come in pieces
            n, total, last = n + len(batch), total + int(batch["amount"].sum()), max(last, int(batch["at_ms"].max()))
        self.totals.update((n, total, last))
        if last > known:
            if known:
                self.handle.deleteTimer(known + self.quiet_ms)
            self.handle.registerTimer(last + self.quiet_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, total, last = self.totals.get()
        self.totals.clear()
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "total": [total], "last_ms": [last]})

    def close(self) -> None:
        pass


def quiet_totals(stream: DataFrame, key: str, amount: str, time: str, quiet_ms: int, first: DataFrame | None = None) -> DataFrame:
    """key, n, total and last_ms of every key that had no row for `quiet_ms`; `amount` is a whole number.

    `stream` has a watermark on `time` and belongs to a session of `state_session`. `first` (key, total)
    is what keys begin with; a key that comes again after it was given begins at zero. A state
    is three numbers, and rows of a key come as an iterator, so a hot key is never held whole.
    """
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(key, F.col(amount).cast("bigint").alias("amount"), F.unix_millis(F.col(time)).alias("at_ms"), time)
    return rows.groupBy(key).transformWithStateInPandas(
        QuietTotals(key, quiet_ms), f"{key} {kind}, n bigint, total bigint, last_ms bigint", "Append", "EventTime",
        initialState=None if first is None else first.select(key, F.col("total").cast("bigint").alias("total")).groupBy(key))
