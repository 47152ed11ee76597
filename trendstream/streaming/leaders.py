"""The leading topics of the last minutes as a live product.

A stream counts topics by time of event and hands on, in update mode, the counts
that a micro-batch changed.  The sink keeps them as versions of two small tables:
the counts of the last ``minutes`` (the version before, with changed counts put
in place of theirs) and the leaders by them.  So a report costs one read of a few
rows, and a micro-batch costs what happened in the last minutes, however long the
stream has run.  The result does not depend on the order of arrival: a row is
late only when it is older than the last ``minutes`` before the newest one.

A micro-batch's version is complete once its leaders are.  A repeated micro-batch
writes it again from the version before, so counts never add up twice.  The last
``KEEP`` versions stay, for that and for a reader that began before the newest
was there.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.operators.longterm import RECENT_MINUTES, TOP_K
from trendstream.streaming.runner import start

COUNTS, LEADERS = "counts", "leaders"
COUNTS_SCHEMA = "at timestamp, topic string, n bigint, newest timestamp"
LEADERS_SCHEMA = "topic string, count bigint, rank int"
KEEP = 2


def changing_counts(rows: DataFrame, minutes: int = RECENT_MINUTES, slot: str | None = None,
                    ts: str = "ts", topic: str = "topic") -> DataFrame:
    """Stream of (ts, topic) rows -> (at, topic, n, newest), for update mode.

    Counts are by exact time, or by slots of time: then state and tables hold a
    number for each topic and slot, and the leaders are those of the slots that
    begin after the bound.  Rows without a time are left out.
    """
    dated = rows.where(F.col(ts).isNotNull()).withWatermark(ts, f"{minutes} minutes")
    key = F.col(ts) if slot is None else F.window(ts, slot)
    counted = dated.groupBy(key.alias("at"), F.col(topic).alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("newest"))
    return counted if slot is None else counted.withColumn("at", F.col("at.start"))


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Micro-batches whose version is complete, oldest first."""
    at, fs = _folder(spark, f"{path}/{LEADERS}")
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(_folder(spark, f"{path}/{LEADERS}/{n}/_SUCCESS")[0]))


def _version(spark: SparkSession, path: str, table: str, number: int) -> str:
    return f"{path}/{table}/{number:012d}"


def upsert_writer(path: str, minutes: int = RECENT_MINUTES, k: int = TOP_K):
    """foreachBatch function: the counts a micro-batch changed -> the next version."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark, path) if v < batch_id]
        counts = batch.select("at", "topic", "n", "newest")
        if before:
            old = spark.read.schema(COUNTS_SCHEMA).parquet(_version(spark, path, COUNTS, before[-1]))
            counts = counts.unionByName(old)
        # a count only grows, so the larger of two is the later one
        counts = counts.groupBy("at", "topic").agg(F.max("n").alias("n"), F.max("newest").alias("newest"))
        new = _version(spark, path, COUNTS, batch_id)
        since = F.max("newest") - F.lit(_dt.timedelta(minutes=minutes))
        counts.persist()
        try:
            bound = counts.agg(since.alias("since")).first()["since"]
            counts.where(F.col("at") > F.lit(bound)).write.mode("overwrite").parquet(new)
        finally:
            counts.unpersist()
        _leaders(spark.read.schema(COUNTS_SCHEMA).parquet(new), k).write.mode("overwrite").parquet(
            _version(spark, path, LEADERS, batch_id))
        for table in (LEADERS, COUNTS):
            for v in before[:-(KEEP - 1)]:
                old_at, fs = _folder(spark, _version(spark, path, table, v))
                fs.delete(old_at, True)
    return write


def _leaders(counts: DataFrame, k: int) -> DataFrame:
    top = (counts.groupBy("topic").agg(F.sum("n").alias("count"))
           .orderBy(F.col("count").desc(), F.col("topic")).limit(k))
    best = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("less"), F.col("topic").alias("topic"))))
    return (top.agg(best.alias("best")).select(F.posexplode("best").alias("place", "b"))
            .select("b.topic", (-F.col("b.less")).alias("count"), (F.col("place") + 1).alias("rank")).coalesce(1))


def start_leaders(rows: DataFrame, path: str, checkpoint: str, minutes: int = RECENT_MINUTES, k: int = TOP_K,
                  slot: str | None = None, mode: str = "once", interval: str = "10 seconds"):
    """Stream of (ts, topic) rows -> versions of counts and leaders under ``path``, one for each checkpoint."""
    return start(changing_counts(rows, minutes, slot), sink="foreachBatch", output_mode="update", checkpoint=checkpoint,
                 mode=mode, interval=interval, foreach_batch=upsert_writer(path, minutes, k))


def current(spark: SparkSession, path: str) -> DataFrame:
    """(topic, count, rank) of the newest complete version; no rows before the first."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], LEADERS_SCHEMA)
    return spark.read.schema(LEADERS_SCHEMA).parquet(_version(spark, path, LEADERS, known[-1]))
