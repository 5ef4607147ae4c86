"""Rows held back in keyed state until enough have come or the first has waited long enough."""

from __future__ import annotations

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

MAX_ROWS = 100       # fixed value: rows of a topic after which its buffer is flushed
MAX_WAIT_MS = 30_000  # fixed value: time after which it is flushed anyway

#: Keyed state with timers needs this store; streams that start inside ``timers`` get it.
_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FLUSHED = (T.StructType().add("topic", "string").add("salt", "integer").add("flush", "long").add("reason", "string")
           .add("value", "string"))


@contextmanager
def timers(spark: SparkSession):
    """Streams that start inside may keep state with timers; those with a checkpoint keep the store they have."""
    before = spark.conf.get(_SETTING)
    spark.conf.set(_SETTING, STORE)
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)


class FlushBuffer(StatefulProcessor):
    """One topic and salt's buffer: the rows in order, and how many flushes it has had.

    It is flushed ``max_rows`` rows at a time, as soon as so many are there (reason ``count``), and wholly when
    ``max_wait_ms`` have passed since its oldest row came (``timer``). At most ``max_rows - 1`` rows stay.
    """

    def __init__(self, max_rows: int, max_wait_ms: int, time_column: str | None = None):
        self.max_rows, self.max_wait_ms, self.time_column = max_rows, max_wait_ms, time_column

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType().add("value", "string"))
        self.flushes = handle.getValueState("flushes", T.StructType().add("n", "long"))

    def _held(self) -> list[str]:
        return [r[0] for r in self.rows.get()] if self.rows.exists() else []

    def _out(self, key, values: list[str], reason: str) -> pd.DataFrame:
        number = (self.flushes.get()[0] if self.flushes.exists() else 0) + 1
        self.flushes.update((number,))
        return pd.DataFrame({"topic": key[0], "salt": key[1], "flush": number, "reason": reason, "value": values},
                            columns=FLUSHED.names).astype({"salt": "int32", "flush": "int64"})

    def handleInputRows(self, key, rows, timerValues):
        before, came = self._held(), [timerValues.getCurrentProcessingTimeInMs()]
        held = list(before)
        for part in rows:
            held += part["value"].tolist()
            if self.time_column:
                came += [int(t.timestamp() * 1000) for t in part[self.time_column]]
        full = len(held) - len(held) % self.max_rows
        for first in range(0, full, self.max_rows):
            yield self._out(key, held[first:first + self.max_rows], "count")
        left = held[full:]
        if full or not before:  # the oldest row is a new one
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if left:
                since = min(came[-len(left):]) if self.time_column else came[0]
                self.handle.registerTimer(since + self.max_wait_ms)
        if left:
            self.rows.put([(v,) for v in left])
        else:
            self.rows.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self._held()
        self.rows.clear()
        if held:
            yield self._out(key, held, "timer")

    def close(self) -> None:
        pass


def buffered(events: DataFrame, max_rows: int = MAX_ROWS, max_wait_ms: int = MAX_WAIT_MS, salts: int = 1,
             time_column: str | None = None, late: str = "0 seconds") -> DataFrame:
    """(topic, salt, flush, reason, value): the rows of a stream of (topic, value), held back and flushed by topic.

    A busy topic is dealt to ``salts`` buffers by the hash of its rows. Time is the cluster's; with ``time_column``
    rows come at the time that it says and the watermark is the clock, so a replay flushes as the first run did, and a run
    over what is there (``availableNow``) ends; by the cluster's time a query must keep running for its timers. The buffer is part of the
    checkpoint: a restart keeps it, and no row comes twice. Null topics are a topic of their own, as the empty text.
    """
    salt = F.pmod(F.xxhash64("value", *([time_column] if time_column else [])), F.lit(salts)).cast("int")
    rows = events.select(F.coalesce("topic", F.lit("")).alias("topic"), salt.alias("salt"), F.col("value"),
                         *([time_column] if time_column else []))
    if time_column:
        rows = rows.withWatermark(time_column, late)
    return rows.groupBy("topic", "salt").transformWithStateInPandas(
        FlushBuffer(max_rows, max_wait_ms, time_column), FLUSHED, "Append",
        "EventTime" if time_column else "ProcessingTime")
