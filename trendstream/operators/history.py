"""History table: create, append (batch, stream or JDBC) and read back.

The table is partitioned by the post date so that long-term queries over a
week or a month prune whole folders, and by the write that made the rows, so
that streams and batch jobs can feed one table.  A stream replaces the partitions
of a micro-batch it has to repeat (exactly once); the JDBC writer is for an
external SQL table and is at-least-once, which the deterministic message ids
make de-duplicable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.schemas import HISTORY_DDL

# Default table name and JDBC port (fixed values).
HISTORY_TABLE = "ItemHistory"
DEFAULT_JDBC_PORT = 1433
PARTITIONS = ["TweetDate", "Writer"]
# Files of one date that one write makes, at most.
FILES_PER_DATE = 8
# Column sizes of the original SQL table (fixed values).
COLUMN_SIZES = {"UniqueId": 37, "Language": 10, "Topic": 255}


def history_table_rows(hist: DataFrame) -> DataFrame:
    """History rows -> table columns (+ TweetDate partition column)."""
    ts = F.try_to_timestamp(F.col("timestamp")) if dict(hist.dtypes)["timestamp"] == "string" \
        else F.col("timestamp").cast("timestamp")
    out = hist.select(F.col("uniqueId").alias("UniqueId"), ts.alias("TweetTime"),
                      F.col("content").alias("Content"), F.col("language").alias("Language"),
                      F.col("topic").alias("Topic"), F.to_date(ts).alias("TweetDate"))
    return out.withColumns({c: _sized(c, n) for c, n in COLUMN_SIZES.items()})


def _sized(column: str, size: int):
    """The column, or an error for a value that is too long, whatever the writer."""
    return F.when(F.coalesce(F.length(column), F.lit(0)) <= size, F.col(column)).otherwise(
        F.raise_error(F.lit(f"{column} is longer than {size} characters")).cast("string"))


def _write(rows: DataFrame, writer: str) -> DataFrame:
    """Table rows of one write, dealt so that a date has a bounded number of files."""
    salt = F.pmod(F.xxhash64("UniqueId"), F.lit(FILES_PER_DATE))
    return rows.withColumn("Writer", F.lit(writer)).repartition(F.col("TweetDate"), salt)


def ensure_table(spark: SparkSession, location: str, name: str = HISTORY_TABLE) -> str:
    """Create the history table over ``location`` if it does not exist."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({HISTORY_DDL}, TweetDate DATE, Writer STRING) "
              f"USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{location}'")
    return name


def append_batch(rows: DataFrame, location: str | None = None, table: str | None = None) -> None:
    """Append a bounded batch of history rows to the table (column sizes are
    enforced) or, without a table name, to the table folder."""
    out = _write(history_table_rows(rows), f"batch-{uuid.uuid4().hex}")
    if table:
        out.write.insertInto(table)
    else:
        out.write.mode("append").partitionBy(*PARTITIONS).parquet(location)


def refresh_partitions(spark: SparkSession, name: str = HISTORY_TABLE) -> None:
    """Register partitions written into the folder by a stream or another job."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def start_stream(rows: DataFrame, location: str, checkpoint: str, mode: str = "once",
                 interval: str = "10 seconds", name: str = "stream"):
    """Stream history rows into the table folder, exactly once; each stream that
    feeds the table has a ``name`` of its own."""
    from trendstream.streaming.runner import start
    return start(rows, sink="foreachBatch", checkpoint=checkpoint, mode=mode, interval=interval,
                 foreach_batch=batch_writer(location, name))


def read_history(spark: SparkSession, location: str, since=None, until=None,
                 dedupe: bool = False) -> DataFrame:
    """Read the table back, through its snapshot pointer once it was compacted
    (``operators.compaction``); date bounds prune partitions.

    ``dedupe`` removes rows written twice by an at-least-once writer (a
    replayed JDBC batch): with deterministic ids, one row per (message, topic)
    is kept.  The key holds the message id, so one hot topic is spread over
    many reducers.
    """
    from trendstream.operators import compaction
    df = None
    if compaction.snapshot(spark, location)["dates"]:
        df = compaction.read(spark, location, since, until)
    if df is None:
        df = spark.read.parquet(location).drop("Writer")
    if since is not None:
        df = df.where(F.col("TweetDate") >= F.to_date(F.lit(since)))
    if until is not None:
        df = df.where(F.col("TweetDate") < F.to_date(F.lit(until)))
    return df.dropDuplicates(["UniqueId", "Topic"]) if dedupe else df


def jdbc_port(text) -> F.Column:
    """Port setting: all-digit text -> int, otherwise the default port."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike("^[0-9]+$"), F.coalesce(c.try_cast("int"), F.lit(DEFAULT_JDBC_PORT))) \
        .otherwise(F.lit(DEFAULT_JDBC_PORT))


def batch_writer(location: str, name: str = "stream"):
    """foreachBatch function: each micro-batch replaces the partitions it wrote
    before, so a batch replayed after a failure overwrites instead of
    duplicating (exactly-once output with an idempotent writer)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (_write(history_table_rows(batch), f"{name}-{batch_id}").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(location))
    return write


def jdbc_writer(url: str, table: str = HISTORY_TABLE, properties: dict | None = None):
    """foreachBatch function appending each micro-batch over JDBC (batched inserts)."""
    props = {"batchsize": "1000", **(properties or {})}

    def write(batch: DataFrame, batch_id: int) -> None:
        (history_table_rows(batch).drop("TweetDate")
         .write.jdbc(url, table, mode="append", properties=props))
    return write
