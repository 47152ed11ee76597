"""Alert watcher: read alert payloads, keep fresh ones, decide success.

Malformed payloads (bad JSON, bad dates, NULL bodies) are skipped, and an
alert is fresh when its window starts strictly after the start time.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.functions import codec

# Deadline of the end-to-end check (fixed value, minutes).
DEADLINE_MINUTES = 15


def parsed_alerts(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Alert payloads -> (windowStart, windowEnd, topic, count); malformed rows dropped."""
    return (_parsed(bodies, body)
            .select(codec.parse_alert_time("a.windowStart").alias("windowStart"),
                    codec.parse_alert_time("a.windowEnd").alias("windowEnd"),
                    "a.topic", F.col("a.count").try_cast("bigint").alias("count"))
            .where(F.col("windowStart").isNotNull()))


def _parsed(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Payloads with their parsed fields ``a`` (one parse each); NULL for what is not an alert."""
    return bodies.select(codec.parse_alert(F.col(body).cast("string")).alias("a"))


def rejected_payloads(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row: payloads received, alerts among them, and payloads rejected."""
    valid = F.count(codec.parse_alert_time("a.windowStart"))
    return _parsed(bodies, body).agg(F.count(F.lit(1)).alias("received"), valid.alias("valid"),
                                     (F.count(F.lit(1)) - valid).alias("rejected"))


def rejected_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(body, reason): the payloads that are no alerts, for a dead-letter table; in batch and in streams."""
    text = F.col(body).cast("string")
    start = codec.parse_alert_time(F.from_json(text, "windowStart string")["windowStart"])
    reason = (F.when(text.isNull(), F.lit("no payload"))
              .when(~codec.one_json_object(text), F.lit("not one JSON object"))
              .when(start.isNull(), F.lit("no window start")))
    return bodies.select(F.col(body), reason.alias("reason")).where(F.col("reason").isNotNull())


def observed(bodies: DataFrame, name: str = "received"):
    """(DataFrame, Observation): payloads received and valid alerts are counted
    as metrics of whatever job consumes the DataFrame, without a second pass."""
    from pyspark.sql import Observation
    obs = Observation(name)
    ws = codec.parse_alert_time(codec.parse_alert(F.col("body").cast("string"))["windowStart"])
    return bodies.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(ws).alias("valid")), obs


def _start(start) -> Column:
    return F.to_timestamp(F.lit(start)) if isinstance(start, str) else F.lit(start)


def fresh_alerts(bodies: DataFrame, start) -> DataFrame:
    """Alerts whose window starts strictly after ``start``."""
    return parsed_alerts(bodies).where(F.col("windowStart") > _start(start))


def alert_summary(bodies: DataFrame, start) -> DataFrame:
    """One row: payloads received, valid alerts, fresh alerts, latest window start, success."""
    ws = F.col("ws")
    fresh = F.count_if(ws > _start(start))
    parsed = _parsed(bodies).select(codec.parse_alert_time("a.windowStart").alias("ws"))
    return parsed.agg(F.count(F.lit(1)).alias("received"),
                      F.count(ws).alias("valid"),
                      fresh.alias("fresh"),
                      F.max(ws).alias("last_window_start"),
                      (fresh > 0).alias("has_fresh"))


def has_fresh(bodies: DataFrame, start) -> bool:
    """True as soon as one fresh alert exists (stops at the first one found)."""
    return not fresh_alerts(bodies, start).limit(1).isEmpty()


def wait_for(read_alerts, start, deadline_minutes: float = DEADLINE_MINUTES,
             poll_seconds: float = 10.0) -> bool:
    """Poll ``read_alerts()`` (a bounded read of the alerts topic) until a fresh
    alert appears or the deadline passes."""
    end = time.monotonic() + deadline_minutes * 60
    while True:
        if has_fresh(read_alerts(), start):
            return True
        if time.monotonic() >= end:
            return False
        time.sleep(poll_seconds)
