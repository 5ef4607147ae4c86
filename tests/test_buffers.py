"""Buffers that are flushed by count or by time."""

from __future__ import annotations

import datetime as dt

import pandas as pd

from ludolake.streaming import buffers

START = dt.datetime(2024, 1, 1)


class Held:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return iter(self.value) if isinstance(self.value, list) else self.value

    def update(self, value):
        self.value = value

    put = update

    def clear(self):
        self.value = None


class Handle:
    """State and timers of one key, and a clock that the test sets."""

    def __init__(self):
        self.timers, self.now = [], 0

    def getListState(self, name, schema):
        return Held()

    getValueState = getListState

    def listTimers(self):
        return iter(list(self.timers))

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_count_and_timer_by_a_clock_that_the_test_sets():
    handle, buffer, out = Handle(), buffers.FlushBuffer(4, 1000), []
    buffer.init(handle)

    def arrive(at, *values):
        handle.now = at
        for timer in [t for t in handle.timers if t <= at]:
            handle.timers.remove(timer)
            out.extend(buffer.handleExpiredTimer(("t", 0), handle, timer))
        out.extend(buffer.handleInputRows(("t", 0), [pd.DataFrame({"value": [v]}) for v in values], handle) if values else [])

    arrive(0, "a", "b")
    assert not out and handle.timers == [1000]
    arrive(500, "c")
    assert not out and handle.timers == [1000]
    arrive(600, "d", "e")              # the count is reached, and e waits from now on
    assert [list(f["value"]) for f in out] == [list("abcd")] and handle.timers == [1600]
    arrive(1000)
    assert len(out) == 1
    arrive(1600)
    assert list(out[1]["value"]) == ["e"] and out[1]["reason"][0] == "timer" and not handle.timers
    arrive(1700, *"fghijklmn")         # two full flushes and a rest
    arrive(9000)
    assert [(f["flush"][0], f["reason"][0], len(f)) for f in out] == [
        (1, "count", 4), (2, "timer", 1), (3, "count", 4), (4, "count", 4), (5, "timer", 1)]
    assert "".join(v for f in out for v in f["value"]) == "abcdefghijklmn"


def test_a_restart_keeps_the_buffer_and_no_row_comes_twice(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "topic STRING, value STRING, at TIMESTAMP"

    def arrive(rows):
        spark.createDataFrame([(t, v, START + dt.timedelta(seconds=s)) for t, v, s in rows], schema).coalesce(1).write.mode(
            "append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        with buffers.timers(spark):
            (buffers.buffered(stream, max_rows=10, time_column="at").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-c").trigger(availableNow=True).start().awaitTermination())
        return [tuple(r) for r in spark.read.schema(buffers.FLUSHED).parquet(out).orderBy("topic", "flush", "value").collect()]

    assert arrive([("a", f"a{i}", i) for i in range(7)]) == []
    rows = arrive([("a", f"b{i}", 8) for i in range(5)] + [("b", "x", 8)])   # 12 of topic a: ten go, two stay
    assert len(rows) == 10 and {(r[0], r[2], r[3]) for r in rows} == {("a", 1, "count")}
    rows = arrive([("c", "later", 100)]) and arrive([("c", "last", 101)])     # the watermark passes the timers
    assert sorted((r[0], r[3]) for r in rows[10:]) == [("a", "timer"), ("a", "timer"), ("b", "timer")]
    values = [r[4] for r in rows]
    assert len(set(values)) == len(values) == 13
