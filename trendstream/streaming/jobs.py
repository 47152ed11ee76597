"""The whole dataflow as jobs over one configuration.

initialize  create the history table if missing
ingest      message source -> raw topic (shares skipped)
enrich      raw topic -> enriched topic            (stateless stream)
history     enriched topic -> history table        (stream, exactly-once file sink)
alerts      enriched topic -> alerts topic         (stateful sliding count + threshold)
leaders     enriched topic -> leading topics of the last minutes (versions of a small table)
watch       alerts topic -> success if a fresh alert appears before the deadline

Every stream job has its own checkpoint under ``root``; ``mode`` is "once"
(process what is there, then stop) or "continuous".
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.functions.langmodel import LanguageModel
from trendstream.operators import history as H
from trendstream.operators import trends as TR
from trendstream.sources.timeline import ORDERED, ROWS_PER_FILE, arrange
from trendstream.sources.topics import producer_path, read_topic
from trendstream.streaming import ingest as I
from trendstream.streaming import pipelines as P
from trendstream.streaming.runner import ProgressCounts, start


@dataclass
class PipelineConfig:
    root: str
    table: str = H.HISTORY_TABLE
    threshold: int = TR.ALERT_THRESHOLD
    length: str = TR.WINDOW_LENGTH
    slide: str = TR.WINDOW_SLIDE
    delay: str = TR.WATERMARK_DELAY
    mode: str = "once"
    interval: str = "10 seconds"
    gazetteer: list[str] | None = None
    # a learned language model saved at this path (functions.langmodel); stop words without one
    language_model: str | None = None
    # "files": topics are folders under root; "kafka": topics are broker topics
    # named raw/enriched/alerts, reached with ``topic_options``
    # (kafka.bootstrap.servers, security settings, ...)
    topic_kind: str = "files"
    topic_options: dict = field(default_factory=dict)
    # most files (file topics) or offsets (broker topics) in a micro-batch
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    # payloads of a file of the raw and enriched topics, which are in event-time order
    rows_per_file: int = ROWS_PER_FILE
    extra: dict = field(default_factory=dict)

    def _topic(self, name):
        return name if self.topic_kind == "kafka" else f"{self.root}/topics/{name}"

    @property
    def raw_topic(self):
        return self._topic("raw")

    @property
    def enriched_topic(self):
        return self._topic("enriched")

    @property
    def alerts_topic(self):
        return self._topic("alerts")

    def read(self, spark, topic: str, file_kind: str = "text", stream: bool = True):
        if self.topic_kind == "kafka":
            limit = {"maxOffsetsPerTrigger": str(self.max_offsets_per_trigger)} \
                if stream and self.max_offsets_per_trigger else {}
            return read_topic(spark, topic, "kafka", stream=stream, options={**self.topic_options, **limit})
        producer = I.ALERTS if topic == self.alerts_topic else ORDERED
        return read_topic(spark, topic, file_kind, stream=stream, producers=(producer,),
                          max_files_per_trigger=self.max_files_per_trigger)

    def sink(self, topic: str, job: str) -> dict:
        """Arguments of ``runner.start`` that write payloads to ``topic``."""
        if self.topic_kind == "kafka":
            return {"sink": "kafka", "options": {"topic": topic, **self.topic_options}}
        return {"sink": "text", "path": producer_path(topic, job)}

    @property
    def history_location(self):
        return f"{self.root}/tables/history"

    @property
    def leaders_location(self):
        return f"{self.root}/tables/leaders"

    @property
    def rejected_location(self):
        return f"{self.root}/tables/rejected"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"


def initialize(spark: SparkSession, cfg: PipelineConfig) -> str:
    return H.ensure_table(spark, cfg.history_location, cfg.table)


def ingest_job(posts: DataFrame, cfg: PipelineConfig, time_col: str | None = None) -> None:
    if cfg.topic_kind == "kafka":
        from trendstream.sources.topics import produce_raw, write_topic
        if "isShareOrRetweet" in posts.columns:
            posts = posts.where(~F.coalesce(F.col("isShareOrRetweet"), F.lit(False)))
        write_topic(produce_raw(posts, "text", time_col, I._key(posts)), cfg.raw_topic, "kafka", cfg.topic_options)
    else:
        I.ingest(posts, cfg.raw_topic, time_col=time_col, rows_per_file=cfg.rows_per_file)


def continuous_ingest_job(posts: DataFrame, cfg: PipelineConfig, time_col: str | None = None):
    """A stream of posts -> raw topic; runs on in continuous mode."""
    if cfg.topic_kind == "kafka":
        from trendstream.sources.topics import produce_raw
        raw = produce_raw(posts, "text", time_col, I._key(posts))
        return start(raw.withColumnRenamed("body", "value").drop("enqueuedTime"), checkpoint=cfg.checkpoint("ingest"),
                     mode=cfg.mode, interval=cfg.interval, **cfg.sink(cfg.raw_topic, I.INGEST))
    return I.start_ingest(posts, cfg.raw_topic, cfg.checkpoint("ingest"), time_col=time_col, mode=cfg.mode,
                          interval=cfg.interval, rows_per_file=cfg.rows_per_file)


def enrichment_job(spark: SparkSession, cfg: PipelineConfig):
    model = LanguageModel.load(spark, cfg.language_model) if cfg.language_model else None
    if cfg.topic_kind == "files":
        _in_order(spark, cfg, cfg.raw_topic, "enrich")
        return I.start_enrichment(spark, cfg.raw_topic, cfg.enriched_topic, cfg.checkpoint("enrich"),
                                  mode=cfg.mode, gazetteer=cfg.gazetteer, interval=cfg.interval,
                                  max_files_per_trigger=cfg.max_files_per_trigger, rows_per_file=cfg.rows_per_file, model=model)
    from trendstream.operators import enrich as ER
    bodies = P.enriched_bodies(ER.enrich(cfg.read(spark, cfg.raw_topic), gazetteer=cfg.gazetteer, model=model))
    return start(bodies.select(F.col("body").alias("value")), checkpoint=cfg.checkpoint("enrich"),
                 mode=cfg.mode, interval=cfg.interval, **cfg.sink(cfg.enriched_topic, I.ENRICH))


def history_job(spark: SparkSession, cfg: PipelineConfig):
    rows = P.history(cfg.read(spark, cfg.enriched_topic))
    return H.start_stream(rows, cfg.history_location, cfg.checkpoint("history"), mode=cfg.mode,
                          interval=cfg.interval)


def _in_order(spark: SparkSession, cfg: PipelineConfig, topic: str, job: str) -> None:
    """A job that starts on a backlog takes its files by event time, whatever the order of their writes."""
    begun = spark._jvm.org.apache.hadoop.fs.Path(cfg.checkpoint(job) + "/offsets")
    if not begun.getFileSystem(spark._jsc.hadoopConfiguration()).exists(begun):
        arrange(spark, topic)


def alerts_job(spark: SparkSession, cfg: PipelineConfig):
    """Sliding counts over the enriched topic (``ProgressCounts.complete`` waits for a run and makes dropped rows an error)."""
    if cfg.topic_kind == "files":
        _in_order(spark, cfg, cfg.enriched_topic, "alerts")
    alerts = P.alerts(cfg.read(spark, cfg.enriched_topic), cfg.threshold,
                      cfg.length, cfg.slide, cfg.delay)
    return start(P.alert_bodies(alerts).select(F.col("body").alias("value")),
                 checkpoint=cfg.checkpoint("alerts"), mode=cfg.mode, interval=cfg.interval,
                 **cfg.sink(cfg.alerts_topic, I.ALERTS))


def leaders_job(spark: SparkSession, cfg: PipelineConfig, slot: str | None = None):
    """The leading topics of the last minutes, kept up as the enriched topic grows (``leaders.current`` reads them)."""
    from trendstream.operators import topics as T
    from trendstream.streaming.leaders import start_leaders
    rows = T.explode_topics(T.decode_enriched(cfg.read(spark, cfg.enriched_topic), narrow=True), tz_aware=True)
    return start_leaders(rows, cfg.leaders_location, cfg.checkpoint("leaders"), slot=slot, mode=cfg.mode, interval=cfg.interval)


def rejected_job(spark: SparkSession, cfg: PipelineConfig):
    """Payloads of the enriched topic that its consumers can't read -> the dead-letter table."""
    from trendstream.operators import topics as T
    return start(T.rejected_payloads(cfg.read(spark, cfg.enriched_topic)), sink="parquet", path=cfg.rejected_location,
                 checkpoint=cfg.checkpoint("rejected"), mode=cfg.mode, interval=cfg.interval)


def watch_job(spark: SparkSession, cfg: PipelineConfig, start_time, deadline_minutes: float = 15,
              poll_seconds: float = 10.0) -> bool:
    """Incremental watch: every poll reads only the alert files that are new."""
    import uuid

    from trendstream.streaming.watcher import wait_for_fresh
    return wait_for_fresh(lambda: cfg.read(spark, cfg.alerts_topic), start_time,
                          f"{cfg.root}/watch/{uuid.uuid4().hex}", deadline_minutes, poll_seconds)


def run_once(spark: SparkSession, cfg: PipelineConfig, posts: DataFrame,
             time_col: str | None = None) -> None:
    """initialize, ingest, then enrichment, history and alerts to completion."""
    initialize(spark, cfg)
    ingest_job(posts, cfg, time_col)
    enrichment_job(spark, cfg).awaitTermination()
    counts = ProgressCounts()
    spark.streams.addListener(counts)
    try:
        qh, qa = history_job(spark, cfg), alerts_job(spark, cfg)
        qh.awaitTermination()
        counts.complete(qa)
    finally:
        spark.streams.removeListener(counts)
    H.refresh_partitions(spark, cfg.table)
