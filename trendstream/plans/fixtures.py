"""Inputs of the registered queries, derived by Spark from the given tables.

events    -> enriched posts: content = props, timestamp = ts, language 'en',
             entities = [event_type, 'user_' || user_id]  (two topics per post)
events    -> statuses of a post service (id, text, created_at, counters, share flag)
documents -> messages (id, text, lang, source) for search, paging and enrichment
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.sources.tables import read_table

# Fixture rule (fixed value): a 'view' event stands for a share / retweet.
SHARE_EVENT_TYPE = "view"


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_from_events(read_table(spark, sf_dir, "events"))


def enriched_from_events(ev: DataFrame) -> DataFrame:
    """Works on a bounded or a streaming events DataFrame."""
    return ev.select(
        F.col("props").alias("content"),
        F.col("ts").alias("timestamp"),
        F.lit("en").alias("language"),
        F.array(F.col("event_type"), F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("entities"))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-service statuses: the shape a search client hands over."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("props").alias("text"),
        F.col("ts").alias("created_at"),
        F.col("value").try_cast("int").alias("retweet_count"),
        F.col("user_id").try_cast("int").alias("favorite_count"),
        (F.col("event_type") == F.lit(SHARE_EVENT_TYPE)).alias("is_retweet"),
        F.lit("en").alias("lang"))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), "text", "lang", "source")


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts whose text names two topics, the event's type and its user's group, as capitalised words."""
    ev = read_table(spark, sf_dir, "events")
    group = F.concat(F.char((F.col("user_id") % 20 + 65).cast("bigint")), F.lit("roup"))
    return ev.select(F.col("event_id").alias("id"), F.concat_ws(" by ", F.initcap("event_type"), group).alias("text"),
                     F.col("ts").alias("created_at"))
