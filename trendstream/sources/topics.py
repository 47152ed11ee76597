"""Topics: the raw, enriched and alerts streams between the stages.

A topic is either a folder of files (the tested form) or a Kafka topic when
the Kafka connector is on the class path.  Readers return a ``body`` column
(plus ``enqueuedTime`` where the topic carries one) in batch or streaming
form; the same downstream functions consume both.

File layouts:
  text     one payload per line (enriched and alert JSON)
  parquet  body BINARY, enqueuedTime TIMESTAMP (raw posts)

A file topic is a folder with one sub-folder per producer: ``batch-<number>``
for each batch append, a name of its own for each streaming sink.  Batch
appends are complete once they are there (an aborted attempt stays in a hidden
folder), so they are read through one glob.  A streaming sink's folder also
holds files of aborted attempts, which only its commit log tells from the
others, so it is read by its own path: name such producers when reading.
Writes in event-time order (``sources.timeline``) share the folder ``ordered``,
which streams name as a producer too.
Each consumer's checkpoint records which files it has already processed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.schemas import RAW
from trendstream.sources.timeline import ORDERED


def _folder(spark: SparkSession, path: str, kind: str, stream: bool, opts: dict) -> DataFrame | None:
    """One producer's folder, or the batch appends; None when a bounded read finds nothing."""
    r = (spark.readStream if stream else spark.read).format(kind).options(**opts)
    try:
        df = (r.schema(RAW) if kind == "parquet" else r).load(path)
    except AnalysisException as e:
        if stream or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return df.withColumnRenamed("value", "body") if kind == "text" else df


def _ensure_folder(spark: SparkSession, path: str) -> None:
    """A stream may start before its producer has written anything."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)


def read_topic(spark: SparkSession, path: str, kind: str = "text", stream: bool = True,
               max_files_per_trigger: int | None = None, options: dict | None = None,
               producers: tuple[str, ...] = ()) -> DataFrame:
    """Open a topic as a streaming (default) or bounded DataFrame.

    ``producers`` names the streaming sinks that feed a file topic; batch
    appends are always read.  ``max_files_per_trigger`` (files) or, for Kafka,
    the option ``maxOffsetsPerTrigger`` bounds a micro-batch.
    """
    opts = dict(options or {})
    if kind in ("text", "parquet"):
        if stream and max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
        if stream:
            for p in producers:
                _ensure_folder(spark, producer_path(path, p))
        names = [*producers, "batch-*"]
        if not stream and ORDERED not in producers:
            names.append(ORDERED)
        found = [df for df in (_folder(spark, producer_path(path, p), kind, stream, opts) for p in names)
                 if df is not None]
        if not found:
            return spark.createDataFrame([], RAW if kind == "parquet" else "body string")
        out = found[0]
        for df in found[1:]:
            out = out.unionByName(df)
        return out
    if kind == "kafka":
        r = spark.readStream if stream else spark.read
        # path = topic name; options carry kafka.bootstrap.servers etc.
        # Bounded reads of alerts start at the beginning of the topic.
        opts.setdefault("subscribe", path)
        if not stream:
            opts.setdefault("startingOffsets", "earliest")
        df = r.format("kafka").options(**opts).load()
        # a record's place in the topic is a key that a replay keeps
        place = F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))
        return df.select(F.col("value").alias("body"), F.col("timestamp").alias("enqueuedTime"),
                         F.coalesce(F.col("key").cast("string"), place).alias("key"))
    raise ValueError(f"unknown topic kind {kind!r}")


def producer_path(topic: str, name: str) -> str:
    """Folder of one producer inside a file topic (streaming sink path)."""
    return f"{topic.rstrip('/')}/{name}"


def _fill_folder(spark: SparkSession, path: str, files: int) -> None:
    """Empty files for the tasks that had no rows and so wrote none, up to ``files``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    there = sum(f.getPath().getName().startswith("part-") for f in fs.listStatus(at))
    for i in range(there, files):
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(at, f"part-empty-{i}.txt")).close()


def write_topic(df: DataFrame, path: str, kind: str = "text", options: dict | None = None,
                files: int | None = None) -> None:
    """Append a bounded DataFrame of payloads to a topic (batch producer).

    With ``files`` a text append has exactly that many, however few its rows are.
    """
    if kind in ("text", "parquet"):
        out = producer_path(path, f"batch-{uuid.uuid4().hex}")
    if files and kind != "text":
        raise ValueError("a number of files is for text topics")
    if files:
        df = df.repartition(files)
    if kind == "text":
        df.select(F.col("body").cast("string").alias("value")).write.text(out)
        if files:
            _fill_folder(df.sparkSession, out, files)
    elif kind == "parquet":
        df.select("body", "enqueuedTime", *[c for c in df.columns if c == "key"]).write.parquet(out)
    elif kind == "kafka":
        (df.select(F.col("body").alias("value"), *[c for c in df.columns if c == "key"]).write.format("kafka")
         .options(**{"topic": path, **(options or {})}).save())
    else:
        raise ValueError(f"unknown topic kind {kind!r}")


def produce_raw(posts: DataFrame, text: str = "text", time_col: str | None = None,
                key: str | None = None) -> DataFrame:
    """Posts -> raw events: UTF-8 body and an arrival time (now unless given),
    with the message's key from column ``key`` if there is one.

    An integral time column is read as epoch milliseconds (message timestamps).
    """
    if time_col is None:
        t = F.current_timestamp()
    elif dict(posts.dtypes)[time_col] in ("bigint", "int"):
        t = F.timestamp_millis(F.col(time_col))
    else:
        t = F.col(time_col).cast("timestamp")
    keys = [F.col(key).cast("string").alias("key")] if key else []
    return posts.select(F.encode(F.col(text), "UTF-8").alias("body"), t.alias("enqueuedTime"), *keys)


def time_slices(df: DataFrame, time_col: str, slices: int) -> list[DataFrame]:
    """``df`` cut at quantiles of its event time, earliest first, for a replay of history.

    Written one after the other with the same number of files each, and read
    with that number as ``max_files_per_trigger``, every micro-batch is one slice:
    event time never runs ahead of rows still to come, so none is dropped as
    late, and state holds a slice's windows, not the whole history's.
    """
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    bounds = [None, *_cuts(df, time_col, slices), None]
    out = []
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            part = part.where(micros > low)
        if high is not None:
            # rows without a time come first
            part = part.where((micros <= high) | micros.isNull() if low is None else micros <= high)
        out.append(part)
    return out


def _cuts(df: DataFrame, time_col: str, slices: int) -> list[int]:
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    found = df.agg(F.percentile_approx(micros, [i / slices for i in range(1, slices)]).alias("c")).first()["c"]
    return sorted(set(found or []))


def stored_slices(df: DataFrame, time_col: str, slices: int) -> Iterator[DataFrame]:
    """The slices of ``time_slices``, written once to the shared folder: many slices do not read ``df`` many times.

    Their files are deleted when the last slice is done with.
    """
    from trendstream.session import discard, fresh_path
    cuts = _cuts(df, time_col, slices)
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    # the cuts before a row's time; rows without a time come first
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c < micros))
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "slices")
    df.withColumn("_slice", number).write.partitionBy("_slice").parquet(path)
    stored = spark.read.schema(df.withColumn("_slice", number).schema).parquet(path)
    try:
        for i in range(len(cuts) + 1):
            yield stored.where(F.col("_slice") == i).drop("_slice")
    finally:
        discard(stored)
