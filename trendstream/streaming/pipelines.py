"""The three stream stages, each a plain DataFrame transformation.

raw topic --enrich--> enriched topic --+--> history table
                                       +--> sliding counts --> threshold --> alerts topic

The functions take a streaming or a bounded DataFrame; ``start`` in
``runner`` attaches a sink and a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from trendstream.functions import codec
from trendstream.operators import topics as T
from trendstream.operators import trends as TR


def enriched_bodies(enriched: DataFrame) -> DataFrame:
    """Enriched columns -> JSON payload column ``body`` (text)."""
    key = "id" if "id" in enriched.columns else None
    return enriched.select(codec.enriched_json(key=key).alias("body"))


def alerts(bodies: DataFrame, threshold: int = TR.ALERT_THRESHOLD,
           length: str = TR.WINDOW_LENGTH, slide: str = TR.WINDOW_SLIDE,
           delay: str = TR.WATERMARK_DELAY) -> DataFrame:
    """Enriched payloads -> alert rows (windowStart, windowEnd, topic, count).

    Parses only timestamp and entities; the watermark is set after the explode
    and before the aggregation.
    """
    rows = T.explode_topics(T.decode_enriched(bodies, narrow=True), tz_aware=True)
    counts = TR.streaming_topic_counts(rows, length, slide, delay)
    return TR.threshold(counts, threshold)


def alert_bodies(alert_rows: DataFrame) -> DataFrame:
    return TR.alert_bodies(alert_rows)


def history(bodies: DataFrame, deterministic_ids: bool = True) -> DataFrame:
    """Enriched payloads -> history rows (one per message and topic)."""
    return T.history_rows(T.decode_enriched(bodies), deterministic_ids)
