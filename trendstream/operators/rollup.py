"""Long-term trends kept up as history grows.

Each micro-batch adds its counts of (day, topic), combined before they are
written, under its own number; a repeated micro-batch replaces them.  Days add up
to weeks and months, so a trend report reads counts of the days it is about and
never the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.operators import longterm as LT

PARTITIONS = ["Day", "Batch"]


def daily_counts(rows: DataFrame, ts: str = "ts", topic: str = "topic") -> DataFrame:
    """(Day, topic, n) of topic rows; rows without a time are left out, as by a calendar report."""
    return (rows.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("Day"), F.col(topic).alias("topic"))
            .agg(F.count(F.lit(1)).alias("n")))


def batch_writer(path: str, name: str = "stream"):
    """foreachBatch function: a batch of (ts, topic) rows -> its counts, replaced when it is repeated."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (daily_counts(batch).withColumn("Batch", F.lit(f"{name}-{batch_id}")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))
    return write


def start_rollup(rows: DataFrame, path: str, checkpoint: str, mode: str = "once", interval: str = "10 seconds",
                 name: str = "stream"):
    """Stream of (ts, topic) rows -> roll-up."""
    from trendstream.streaming.runner import start
    return start(rows, sink="foreachBatch", checkpoint=checkpoint, mode=mode, interval=interval,
                 foreach_batch=batch_writer(path, name))


def counts(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """(Day, topic, n) summed over batches; the bounds prune days."""
    df = spark.read.schema("topic string, n long, Day date, Batch string").parquet(path)
    if since is not None:
        df = df.where(F.col("Day") >= F.to_date(F.lit(since)))
    if until is not None:
        df = df.where(F.col("Day") < F.to_date(F.lit(until)))
    return df.groupBy("Day", "topic").agg(F.sum("n").alias("n"))


def top_topics(spark: SparkSession, path: str, unit: str = "week", k: int = LT.TOP_K, since=None, until=None) -> DataFrame:
    """Leading topics per week (from Monday) or month: period, topic, count, rank, as ``longterm.period_top_topics``."""
    period = F.date_trunc(unit, F.col("Day")).cast("timestamp_ntz")
    summed = counts(spark, path, since, until).groupBy(period.alias("period"), "topic").agg(F.sum("n").alias("count"))
    return LT.top_k_per_group(summed, "period", [F.col("count").desc(), F.col("topic")], k, "topic")
