"""Decode enriched events and turn them into one row per (message, topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trendstream.functions import codec
from trendstream.schemas import ENRICHED, ENRICHED_TRENDS


def decode_enriched(raw: DataFrame, body: str = "body", narrow: bool = False) -> DataFrame:
    """Binary or text payloads -> enriched columns.

    Malformed JSON becomes all-NULL fields (PERMISSIVE) and is then dropped by
    the explode of the consumers, as in the original dataflow.  ``narrow``
    parses only the two fields the trend branch reads.
    """
    b = F.col(body)
    if raw.schema[body].dataType != StringType():
        b = b.cast("string")
    schema = ENRICHED_TRENDS if narrow else ENRICHED
    return raw.select(codec.parse_enriched(b, schema).alias("data")).select("data.*")


def rejected_payloads(raw: DataFrame, body: str = "body") -> DataFrame:
    """(body): payloads that are not one JSON object, which ``decode_enriched`` turns into no row."""
    text = F.col(body).cast("string")
    return raw.select(F.col(body)).where(text.isNull() | ~codec.one_json_object(text))


def event_time(df: DataFrame, col: str = "timestamp", tz_aware: bool = False):
    """Event-time column from either a timestamp or its text form."""
    dt = df.schema[col].dataType.simpleString()
    c = F.col(col)
    if dt == "string":
        # an offset in the text is honoured; without one it is session time
        ts = F.try_to_timestamp(c)
        return ts if tz_aware else ts.cast("timestamp_ntz")
    if tz_aware and dt == "timestamp_ntz":
        return c.cast("timestamp")
    return c


def explode_topics(enriched: DataFrame, time_col: str = "timestamp",
                   entities: str = "entities", tz_aware: bool = False) -> DataFrame:
    """(ts, topic) rows, one per entity; NULL or empty entities drop the message."""
    return enriched.select(event_time(enriched, time_col, tz_aware).alias("ts"),
                           F.explode(entities).alias("topic"))


def unique_id(content="content", timestamp="timestamp", deterministic: bool = True, key: str | None = None):
    """Message id shared by all topics of one message (fits VARCHAR(37)).

    The deterministic form hashes the message's key, so a replayed batch yields
    the same ids and can be de-duplicated, and equal posts keep ids of their
    own; a message without a key is known by its text and time.  The random
    form is ``uuid()``.
    """
    if not deterministic:
        return F.expr("uuid()")
    known = F.concat_ws("\u0001", F.col(content), F.col(timestamp).cast("string"))
    if key is not None:
        known = F.coalesce(F.concat(F.lit("key\u0001"), F.col(key)), known)
    return F.substring(F.sha2(known, 256), 1, 36)


def history_rows(enriched: DataFrame, deterministic_ids: bool = True) -> DataFrame:
    """uniqueId, content, timestamp, language, topic: the history branch.

    The id is assigned before the explode so it identifies the message.
    """
    key = "id" if "id" in enriched.columns else None
    return (enriched
            .select(unique_id(deterministic=deterministic_ids, key=key).alias("uniqueId"),
                    "content", F.col("timestamp").cast("string").alias("timestamp"),
                    "language", "entities")
            .select("uniqueId", "content", "timestamp", "language",
                    F.explode("entities").alias("topic")))
