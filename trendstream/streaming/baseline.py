"""Anomalies as a stream: each window count against its topic's own running baseline.

The baseline is an exponentially weighted mean and variance in keyed state, a few
numbers a topic, so no history is kept or read again.  Counts are taken in event
time behind the watermark (``episodes.InOrder``), so the result does not depend
on their order of arrival.  A topic that was silent for ``forget_seconds`` starts anew.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row

from trendstream.streaming.episodes import ALERT_DELAY, InOrder, _time, in_order

OUTPUT_SCHEMA = ("windowStart timestamp, windowEnd timestamp, topic string, count bigint, baseline_avg double, "
                 "baseline_std double, z double")
WEIGHT = 0.2               # of the newest count
FORGET_SECONDS = 86_400.0


def step(mean: float, variance: float, weight: float, count: float) -> tuple[float, float]:
    """Mean and variance after one more count."""
    off = count - mean
    return mean + weight * off, (1 - weight) * (variance + weight * off * off)


class Baseline(InOrder):
    """Every count with the baseline before it; the state is mean, variance and the end of the last window."""

    STATE = "mean double, variance double, end bigint"

    def __init__(self, weight: float = WEIGHT, forget_seconds: float = FORGET_SECONDS):
        self.weight, self.forget = weight, int(forget_seconds * 1_000_000)

    def take(self, state, topic, start, end, count):
        shown = dict(windowStart=_time(start), windowEnd=_time(end), topic=topic, count=count)
        if state is None or start >= state[2] + self.forget:
            return (float(count), 0.0, end), Row(**shown, baseline_avg=None, baseline_std=None, z=None)
        mean, variance, last = state
        deviation = math.sqrt(variance)
        z = (count - mean) / deviation if variance > 0 else None
        return ((*step(mean, variance, self.weight, float(count)), max(last, end)),
                Row(**shown, baseline_avg=mean, baseline_std=deviation, z=z))

    def until(self, state):
        return state[2] + self.forget


def running_baseline(window_counts: DataFrame, weight: float = WEIGHT, forget_seconds: float = FORGET_SECONDS,
                     delay: str = ALERT_DELAY) -> DataFrame:
    """Streaming window counts -> counts with the topic's baseline before them and their z-score
    (NULL for a topic's first count, z also without variance)."""
    return in_order(window_counts, Baseline(weight, forget_seconds), OUTPUT_SCHEMA, delay)
