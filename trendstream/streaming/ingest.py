"""Ingest and enrichment jobs.

ingest:  posts (any message source) -> skip shares -> raw topic (UTF-8 body,
         arrival time) in order of their time, in one distributed write instead
         of a driver loop;
enrich:  raw topic stream -> language + entities -> enriched JSON topic.
watch a table: new files of a posts table -> raw topic, as they arrive.

Both write their topics in event-time order (``sources.timeline``), so that
consumers may take a few files at a time.  Pacing of the original loop maps to
``max_files_per_trigger`` and a processing-time trigger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.functions import codec
from trendstream.operators import enrich as ER
from trendstream.sources.timeline import ORDERED, ROWS_PER_FILE, publish, publisher
from trendstream.sources.topics import produce_raw, read_topic
from trendstream.streaming.runner import start


# Names of the streaming producers of the raw, enriched and alerts topics.
INGEST, ENRICH, ALERTS = "ingest", "enrich", "alerts"


def _raw(posts: DataFrame, text: str, time_col: str | None, drop_shares: bool) -> DataFrame:
    if drop_shares and "isShareOrRetweet" in posts.columns:
        posts = posts.where(~F.coalesce(F.col("isShareOrRetweet"), F.lit(False)))
    return produce_raw(posts, text, time_col, _key(posts))


def ingest(posts: DataFrame, raw_topic: str, text: str = "text", time_col: str | None = None,
           drop_shares: bool = True, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Publish posts to the raw topic (parquet payloads) in order of their time; shares are skipped."""
    publish(_raw(posts, text, time_col, drop_shares), raw_topic, "parquet", f"posts-{uuid.uuid4().hex}", "enqueuedTime",
            F.col("enqueuedTime"), rows_per_file)


def _key(posts: DataFrame, id_col: str = "id") -> str | None:
    """Posts carry their id as the message's key, so that equal texts stay apart."""
    return id_col if id_col in posts.columns else None


def start_ingest(posts: DataFrame, raw_topic: str, checkpoint: str, text: str = "text",
                 time_col: str | None = None, drop_shares: bool = True, mode: str = "continuous",
                 interval: str = "10 seconds", rows_per_file: int = ROWS_PER_FILE):
    """Continuous ingest: a stream of posts (``sources.tables.stream_table``) to the raw topic.

    The checkpoint is the cursor: a restarted ingest goes on after the last file
    it published.
    """
    return start(_raw(posts, text, time_col, drop_shares), sink="foreachBatch", checkpoint=checkpoint, mode=mode,
                 interval=interval, foreach_batch=publisher(raw_topic, "parquet", INGEST, "enqueuedTime",
                                                            F.col("enqueuedTime"), rows_per_file))


def start_enrichment(spark: SparkSession, raw_topic: str, enriched_topic: str, checkpoint: str,
                     mode: str = "once", max_files_per_trigger: int | None = None,
                     gazetteer: list[str] | None = None, interval: str = "10 seconds",
                     rows_per_file: int = ROWS_PER_FILE, model=None):
    """Stateless enrichment stream from the raw topic to the enriched topic, in event-time order."""
    raw = read_topic(spark, raw_topic, "parquet", max_files_per_trigger=max_files_per_trigger,
                     producers=(ORDERED,))
    enriched = ER.enrich(raw, gazetteer=gazetteer, model=model)
    bodies = enriched.select(codec.enriched_json(key="id" if "id" in enriched.columns else None).alias("body"),
                             F.try_to_timestamp("timestamp").alias("at"))
    return start(bodies, sink="foreachBatch", checkpoint=checkpoint, mode=mode, interval=interval,
                 foreach_batch=publisher(enriched_topic, "text", ENRICH, "at", enriched_time(), rows_per_file))


def enriched_time(body: str = "body"):
    """Event time of an enriched payload."""
    return F.try_to_timestamp(F.get_json_object(body, "$.timestamp"))
