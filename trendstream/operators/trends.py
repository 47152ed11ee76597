"""Sliding-window topic counts and threshold alerts.

Batch path: rows are first counted per (slide bucket, topic), partial + final,
so a topic that holds a large share of all rows is reduced map-side before any
shuffle.  The counts are dealt by (topic, hour), sorted and turned into windows
there, so the x(L/S) expansion never travels nor waits in memory.  The key always
contains the time, so one hot topic spreads over many reducers.

Streaming path: ``window()`` + watermark + state store, append output.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendstream.functions import codec

# Parameters of the original alert job (fixed values).
WINDOW_LENGTH = "10 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK_DELAY = "10 minutes"
ALERT_THRESHOLD = 5

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """'10 minutes' -> 600."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def topic_counts(rows: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE,
                 ts: str = "ts", topic: str = "topic") -> DataFrame:
    """Batch count per (sliding window, topic): windowStart, windowEnd, topic, count.

    A bucket's count travels to the one or two blocks (an hour, a day or a week)
    its windows start in.  There the buckets of a topic are sorted by time, and
    each gives the windows that it is the first bucket of, with the sum of the
    buckets that follow inside them: every window comes out once, and what a task
    holds is the buckets it sorts, not their windows.
    """
    L, S = interval_seconds(length), interval_seconds(slide)
    block = next((unit for unit in ("hour", "day", "week") if L <= _UNITS[unit]), None)
    if L % S or block is None:
        return _topic_counts_direct(rows, length, slide, ts, topic)
    k = L // S
    step, reach = F.lit(_dt.timedelta(seconds=S)), F.lit(_dt.timedelta(seconds=L))
    per_bucket = (rows.groupBy(F.window(ts, slide).start.alias("bucket"), F.col(topic).alias("topic"))
                  .agg(F.count(F.lit(1)).alias("n")))
    bucket = F.col("bucket")
    blocks = F.array_distinct(F.array(F.date_trunc(block, bucket), F.date_trunc(block, bucket - step * (k - 1))))
    dealt = per_bucket.select("bucket", "topic", "n", F.explode(blocks).alias("block")).repartition("topic", "block")
    inside = Window.partitionBy("topic", "block").orderBy("bucket")
    seen = dealt.select("topic", "block", "bucket", "n", F.lag("bucket").over(inside).alias("before"),
                        F.collect_list(F.struct("bucket", "n")).over(inside.rowsBetween(0, k - 1)).alias("next"))
    # The k window starts of a bucket as a literal-size array: stays in codegen.
    first = (seen.select("topic", "block", "n", "before", "next",
                         F.explode(F.array(*[bucket - step * i for i in range(k)])).alias("windowStart"))
             .where((F.date_trunc(block, "windowStart") == F.col("block"))
                    & (F.col("before").isNull() | (F.col("windowStart") > F.col("before")))))
    end = F.col("windowStart") + reach
    within = F.aggregate("next", F.lit(0).cast("bigint"), lambda a, b: a + F.when(b["bucket"] < end, b["n"]).otherwise(0))
    return first.select("windowStart", end.alias("windowEnd"), "topic",
                        F.when(F.size("next") == 1, F.col("n")).otherwise(within).alias("count"))


def _topic_counts_direct(rows, length, slide, ts, topic):
    return (rows.groupBy(F.window(ts, length, slide).alias("w"), F.col(topic).alias("topic"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("windowStart"), F.col("w.end").alias("windowEnd"),
                    "topic", "count"))


def streaming_topic_counts(rows: DataFrame, length: str = WINDOW_LENGTH,
                           slide: str = WINDOW_SLIDE, delay: str = WATERMARK_DELAY,
                           ts: str = "ts", topic: str = "topic") -> DataFrame:
    """Stateful count; in append mode a window is emitted once the watermark passes its end.

    ``ts`` must be TIMESTAMP (not TIMESTAMP_NTZ) for the watermark.
    """
    return (rows.withWatermark(ts, delay)
            .groupBy(F.window(ts, length, slide).alias("w"), F.col(topic).alias("topic"))
            .count()
            .select(F.col("w.start").alias("windowStart"), F.col("w.end").alias("windowEnd"),
                    "topic", "count"))


def threshold(counts: DataFrame, n: int = ALERT_THRESHOLD) -> DataFrame:
    """Windows whose count reaches the threshold (inclusive)."""
    return counts.where(F.col("count") >= F.lit(n))


def alert_bodies(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON payloads in a single ``body`` column."""
    return alerts.select(codec.alert_json().alias("body"))


def closed_windows(counts: DataFrame, rows: DataFrame, delay: str = WATERMARK_DELAY,
                   ts: str = "ts") -> DataFrame:
    """Windows a streaming run in append mode has emitted once all rows are in.

    The final watermark is max(event time) - delay; a window is emitted when
    its end is at or before it.  The max is a scalar subquery, not a join.
    """
    watermark = rows.agg(F.max(ts)).scalar() - F.lit(_dt.timedelta(seconds=interval_seconds(delay)))
    return counts.where(F.col("windowEnd") <= watermark)


def distinct_per_message(enriched: DataFrame, time_col="timestamp", entities="entities"):
    """Topic rows where an entity repeated inside one message counts once."""
    from trendstream.operators.topics import event_time
    return enriched.select(event_time(enriched, time_col).alias("ts"),
                           F.explode(F.array_distinct(entities)).alias("topic"))
