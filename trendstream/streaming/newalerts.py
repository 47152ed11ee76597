"""New-alert stream: the first alert of each episode per topic, for notification.

Keyed state per topic holds the end of the topic's last alert window; an
alert starts a new episode when its window starts at or after that end
(plus an optional quiet gap).  A group is one topic's alerts of a micro-batch,
so the reader's micro-batches bound the pandas work; the state is one
timestamp per topic.

Episodes depend on the order of alerts, so micro-batches have to come in event
time.  The files of an alert job's sink don't: each batch's alerts, days of event
time, are spread over them by key.  To replay a history of alerts, write it in
slices of event time with a fixed number of files each (``sources.topics``), read
one slice a micro-batch, and allow the longest slice as the delay
(``slice_delay``).  Alerts beyond the delay are dropped; the progress of the
query counts them (``runner.rows_dropped_by_watermark``, ``ProgressCounts``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

OUTPUT_SCHEMA = "windowStart timestamp, windowEnd timestamp, topic string, count bigint"
STATE_SCHEMA = "last_end timestamp"


def _episodes(quiet_seconds: float):
    gap = _dt.timedelta(seconds=quiet_seconds)

    def fn(key, pdfs, state):
        import pandas as pd
        if state.hasTimedOut:
            # the watermark passed last_end + gap: any later alert is new anyway
            state.remove()
            return
        parts = list(pdfs)
        if not parts:
            return
        pdf = pd.concat(parts).sort_values("windowStart", kind="stable").reset_index(drop=True)
        # end of the latest earlier alert window of this topic (state, then the batch)
        prev = pdf["windowEnd"].cummax().shift(1)
        if state.exists and state.get[0] is not None:
            last = pd.Timestamp(state.get[0])
            prev = prev.fillna(last).where(prev.isna() | (prev > last), last)
        keep = prev.isna() | (pdf["windowStart"] >= prev + gap)
        newest = pdf["windowEnd"].max()
        if state.exists and state.get[0] is not None:
            newest = max(newest, pd.Timestamp(state.get[0]))
        state.update((newest.to_pydatetime(),))
        state.setTimeoutTimestamp(int((newest + gap).timestamp() * 1000))
        yield pdf.loc[keep, ["windowStart", "windowEnd", "topic", "count"]]
    return fn


# Disorder tolerated between alert rows of a live alert job (alerts of a window
# are emitted once the upstream watermark passes its end, so they arrive
# nearly in order).  A replay takes its own from ``slice_delay``.
ALERT_DELAY = "1 hour"


def slice_delay(slices: list[DataFrame]) -> str:
    """The longest event time that one of the slices of alert rows covers."""
    at = F.unix_micros(F.col("windowStart").cast("timestamp"))
    spans = [s.agg((F.max(at) - F.min(at)).alias("span")).first()["span"] or 0 for s in slices]
    return f"{max(spans, default=0) // 1_000_000 + 1} seconds"


def new_alerts_stream(alert_rows: DataFrame, quiet_seconds: float = 0,
                      delay: str = ALERT_DELAY) -> DataFrame:
    """Streaming alert rows -> rows that open a new episode per topic.

    The per-topic state (end of the last alert window) times out on event
    time once the watermark passes that end plus the quiet gap, so state is
    kept only for topics that alerted recently.
    """
    from trendstream.session import ship_package
    ship_package(alert_rows.sparkSession)
    return (alert_rows.select("windowStart", "windowEnd", "topic", "count")
            .withWatermark("windowStart", delay)
            .groupBy("topic")
            .applyInPandasWithState(_episodes(quiet_seconds), OUTPUT_SCHEMA, STATE_SCHEMA,
                                    "append", GroupStateTimeout.EventTimeTimeout))
