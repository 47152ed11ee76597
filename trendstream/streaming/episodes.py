"""Alert episodes whatever the order of arrival.

Alerts wait in keyed state until the watermark has passed their window's start:
until then an earlier one of the topic may still come.  A timer at the earliest start
wakes the topic, which takes its waiting alerts in event time and emits those that open
a new episode.  State per topic: the waiting alerts (a list, added to and read as a
whole, so a micro-batch costs a topic a few calls), the time it wakes, the
end of the last alert, and how far it has gone.  A topic whose last episode is
over and that has nothing waiting keeps no state.

The delay is the disorder allowed.  What comes later than that is dropped and
counted (``runner.ProgressCounts``).  A bounded run ends with the alerts of the last
``delay`` still waiting; ``heartbeat`` moves event time on without being an alert, as an
idle topic's producer does, so a replay can be brought to its end.

This is the exact form.  ``newalerts.new_alerts_stream`` answers at once and relies
on the order of its input.  List state and timers need the RocksDB state store:
start the query inside ``rocksdb_state``.
"""

from __future__ import annotations

import datetime as _dt
import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trendstream.functions import codec
from trendstream.session import ROCKSDB_PROVIDER

OUTPUT_SCHEMA = "windowStart timestamp, windowEnd timestamp, topic string, count bigint"
ALERT_DELAY = "1 hour"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _millis(micros: int) -> int:
    return -(-micros // 1000)


class InOrder(StatefulProcessor):
    """Takes each key's rows (start, end, count; microseconds) in event time, whatever their order of arrival.

    A subclass keeps ``STATE`` (a tuple, None for a new key): ``take`` moves it on by
    one row and gives the output row or None; ``until`` is the time after which the
    state means nothing any more.
    """

    STATE = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "start bigint, end bigint, count bigint")
        self.wake = handle.getValueState("wake", "start bigint")
        self.state = handle.getValueState("state", self.STATE + ", seen bigint")

    def take(self, state: tuple | None, topic: str, start: int, end: int, count: int) -> tuple[tuple, Row | None]:
        raise NotImplementedError

    def until(self, state: tuple) -> int:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["start"], r["end"], r["count"]) for r in rows if r["topic"] is not None]
        if new:
            self.waiting.appendList(new)
            first = min(w[0] for w in new)
            if not self.wake.exists() or first < self.wake.get()[0]:
                self._wake_at(first)
        return iter([])

    def _wake_at(self, start: int) -> None:
        self.handle.registerTimer(_millis(start))
        self.wake.update((start,))

    def _waiting(self) -> list[tuple[int, int, int]]:
        """Waiting rows by their start; a row delivered twice waits once."""
        found = {}
        for start, end, count in self.waiting.get():
            found[start] = (max(end, found[start][0]) if start in found else end, count)
        return sorted((start, *v) for start, v in found.items())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        *kept, seen = self.state.get() if self.state.exists() else (-1,)
        state, now = tuple(kept) or None, timerValues.getCurrentWatermarkInMs()
        if expiredTimerInfo.getExpiryTimeInMs() <= seen and seen >= now:
            return                                       # taken by an earlier timer of this batch
        waiting = self._waiting() if self.waiting.exists() else []
        ready = [w for w in waiting if _millis(w[0]) <= now]
        for start, end, count in ready:
            state, out = self.take(state, key[0], start, end, count)
            if out is not None:
                yield out
        later = waiting[len(ready):]
        if later:
            if ready:
                self.waiting.put(later)
            self._wake_at(later[0][0])
        else:
            self.waiting.clear()
            self.wake.clear()
        over = state is None or _millis(self.until(state)) <= now
        if over and not later:
            self.state.clear()
        elif state is not None:
            self.state.update((*state, now))
            if not over and ready:
                self.handle.registerTimer(_millis(self.until(state)))

    def close(self) -> None:
        pass


class Episodes(InOrder):
    """First alerts of each episode; the state is the end of the last alert."""

    STATE = "end bigint"

    def __init__(self, quiet_seconds: float = 0):
        self.gap = int(quiet_seconds * 1_000_000)

    def take(self, state, topic, start, end, count):
        last = state[0] if state else None
        new = last is None or start >= last + self.gap
        out = Row(windowStart=_time(start), windowEnd=_time(end), topic=topic, count=count) if new else None
        return (end if last is None else max(last, end),), out

    def until(self, state):
        return state[0] + self.gap                       # any later alert is new anyway


def _time(micros: int) -> _dt.datetime:
    return _dt.datetime.fromtimestamp(0, _dt.timezone.utc) + _dt.timedelta(microseconds=micros)


def alert_episodes(alert_rows: DataFrame, quiet_seconds: float = 0, delay: str = ALERT_DELAY) -> DataFrame:
    """Streaming alert rows -> rows that open a new episode of their topic, for any
    arrival order within ``delay``.

    Rows without a topic (heartbeats) only move event time on.  An alert
    delivered again counts once.
    """
    return in_order(alert_rows, Episodes(quiet_seconds), OUTPUT_SCHEMA, delay)


def in_order(window_rows: DataFrame, processor: InOrder, schema: str, delay: str) -> DataFrame:
    """Streaming (windowStart, windowEnd, topic, count) rows through a processor of each topic."""
    rows = (window_rows.where(F.col("windowStart").isNotNull() & F.col("windowEnd").isNotNull())
            .withWatermark("windowStart", delay)
            .select("windowStart", "topic", F.unix_micros("windowStart").alias("start"),
                    F.unix_micros("windowEnd").alias("end"), "count"))
    # the driver's worker for state has no shipped packages: the processor travels by value
    modules = {sys.modules[c.__module__] for c in type(processor).__mro__ if c.__module__.startswith(__package__)}
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    try:
        return rows.groupBy("topic").transformWithState(processor, schema, "append", "EventTime")
    finally:
        for m in modules:
            cloudpickle.unregister_pickle_by_value(m)


def heartbeat(spark: SparkSession, at: _dt.datetime) -> DataFrame:
    """One payload without a topic whose event time is ``at``."""
    return spark.range(1).select(codec.alert_json(F.lit(at).cast("timestamp"), F.lit(at).cast("timestamp"),
                                                  F.lit(None).cast("string"), F.lit(0)).alias("body"))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (a query takes the setting as it starts)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
