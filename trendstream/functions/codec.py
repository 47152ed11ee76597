"""Column functions for the payloads that cross topic boundaries.

All are built-in expressions, so they stay inside whole-stage codegen and
behave the same in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendstream.schemas import ALERT_TEXT, ENRICHED

# Format of window bounds in alert payloads (fixed value).
ALERT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_body(body="body") -> Column:
    """Broker payload (binary, UTF-8) to text; bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(_c(body).cast("string"))


def encode_text(text="text") -> Column:
    """Post text to broker payload (UTF-8 bytes)."""
    return F.encode(_c(text), "UTF-8")


def parse_alert_time(s) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text to timestamp, NULL when malformed."""
    return F.try_to_timestamp(_c(s), F.lit(ALERT_TIME_FORMAT))


def enriched_json(content="content", timestamp="timestamp", language="language",
                  entities="entities", key=None) -> Column:
    """Enriched event payload with key order content, timestamp, language, entities
    (and the message's id, where it has a key)."""
    return F.to_json(F.struct(_c(content).alias("content"),
                              _c(timestamp).cast("string").alias("timestamp"),
                              _c(language).alias("language"),
                              _c(entities).alias("entities"),
                              *([_c(key).alias("id")] if key is not None else [])), _JSON_KEEP_NULLS)


def parse_enriched(body="body", schema=ENRICHED) -> Column:
    """Enriched payload text to struct; malformed text gives all-NULL fields."""
    return F.from_json(_c(body), schema, {"mode": "PERMISSIVE"})


def alert_json(window_start="windowStart", window_end="windowEnd", topic="topic",
               count="count") -> Column:
    """Alert payload with key order windowStart, windowEnd, topic, count."""
    return F.to_json(F.struct(
        F.date_format(_c(window_start), ALERT_TIME_FORMAT).alias("windowStart"),
        F.date_format(_c(window_end), ALERT_TIME_FORMAT).alias("windowEnd"),
        _c(topic).alias("topic"),
        _c(count).cast("bigint").alias("count")), _JSON_KEEP_NULLS)


def one_json_object(body="body") -> Column:
    """Whether the whole text is exactly one JSON object: no other value, nothing behind it but white space.

    Spark's parsers stop after the first value.  Inside an array a text that goes
    on has to close the array or add an element, inside an object it has to close
    the object or add a field; one object alone is right in both.
    """
    c = _c(body)
    in_array = F.json_array_length(F.concat(F.lit("["), c, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"a":'), c, F.lit("}")))
    return F.coalesce(c.rlike("^[ \\t\\r\\n]*\\{") & (in_array == 1) & in_object.isNotNull(), F.lit(False))


def parse_alert(body="body") -> Column:
    """Alert payload to struct, all fields as text; NULL unless the whole payload is one JSON object."""
    return F.when(one_json_object(body), F.from_json(_c(body), ALERT_TEXT))
