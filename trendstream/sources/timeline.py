"""File topics in event-time order: a manifest of every write, and files admitted by time.

A write deals its payloads to files by ranges of event time and stages them in a
hidden folder.  What commits it is its manifest: one entry a file with the lowest
and highest event time and the number of payloads.  Then the files are admitted,
earliest first: each is stamped with a later modification time than the one
before and moved into the topic's ``ordered`` folder.  Spark's file source takes
files by modification time, so a consumer that reads a few files a micro-batch
meets event time in order, and a watermark never runs ahead of files still to
come.  ``arrange`` stamps what is there again, by the manifests, for a
consumer that starts on several writes that were not made in time order.

A repeated write (same name) finds its manifest and only finishes its admission;
one that failed before its manifest leaves staged files that nobody reads.  On
object stores, where times can't be set, a moved file gets the time of its
move, which is the same order.  Files are as many as ``rows_per_file`` asks for,
so a file, and a micro-batch of a fixed number of them, stays the same size
however long the history is.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Folder of the admitted files of a topic, and the hidden ones beside it.
ORDERED, STAGING, MANIFEST = "ordered", "_staging", "_manifest"
ROWS_PER_FILE = 100_000
# Files of one write, at most (its manifest passes through the driver).
FILES_A_WRITE = 10_000
SUFFIX = {"text": "txt", "parquet": "parquet"}
# A row group of a parquet topic's file: what a consumer's task reads at least, so that one file spreads over many tasks.
ROW_GROUP_BYTES = 4 << 20


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    at = _path(spark, folder)
    fs = _fs(spark, at)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def manifest(spark: SparkSession, topic: str) -> DataFrame:
    """(file, lowest, highest, rows, write): one row for each committed file of the topic."""
    schema = "file string, lowest long, highest long, rows long, write string"
    known = [n for n in _names(spark, f"{topic}/{MANIFEST}") if n.endswith(".json")]
    raw = spark.read.schema(schema).json(f"{topic}/{MANIFEST}/*.json") if known else spark.createDataFrame([], schema)
    return raw.select("file", F.timestamp_micros("lowest").alias("lowest"), F.timestamp_micros("highest").alias("highest"),
                      "rows", "write")


def _committed(spark: SparkSession, topic: str, write: str) -> list[dict] | None:
    at = _path(spark, topic, MANIFEST, f"{write}.json")
    if not _fs(spark, at).exists(at):
        return None
    return [r.asDict() for r in spark.read.schema("file string, staged string, lowest long").json(at.toString()).collect()]


def _commit(spark: SparkSession, topic: str, write: str, entries: list[dict]) -> None:
    """The manifest appears as a whole: written beside its place, then renamed."""
    at, beside = _path(spark, topic, MANIFEST, f"{write}.json"), _path(spark, topic, MANIFEST, f".{write}.tmp")
    fs = _fs(spark, at)
    out = fs.create(beside, True)
    out.write(bytearray("".join(json.dumps(e) + "\n" for e in entries).encode()))
    out.close()
    if not fs.rename(beside, at):
        raise OSError(f"{at.toString()} could not be written")


def _stamps(after: int = 0):
    """Times in milliseconds, each later than the one before."""
    last = after
    while True:
        last = max(last + 1, time.time_ns() // 1_000_000)
        yield last


def _stamp(fs, path, at: int) -> None:
    try:
        fs.setTimes(path, at, -1)
    except Exception as e:  # stores without it give a moved file the time of its move
        if "UnsupportedOperation" not in str(e):
            raise


def _admit(spark: SparkSession, topic: str, entries: list[dict]) -> None:
    """Move staged files into the ordered folder, earliest first (those already there stay)."""
    folder = _path(spark, topic, ORDERED)
    fs = _fs(spark, folder)
    fs.mkdirs(folder)
    stamps = _stamps()
    for e in sorted(entries, key=lambda e: (e["lowest"] is not None, e["lowest"] or 0, e["file"])):
        there, staged = _path(spark, topic, ORDERED, e["file"]), _path(spark, topic, STAGING, e["staged"])
        if not fs.exists(there):
            _stamp(fs, staged, next(stamps))
            if not fs.rename(staged, there):
                raise OSError(f"{staged.toString()} could not be admitted")


def publish(payloads: DataFrame, topic: str, kind: str, write: str, time_col: str, read_time: Column,
            rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append payloads to a file topic, in order of the timestamp column ``time_col``.

    ``write`` names the append: repeating it changes nothing.  For text topics the
    payload is column ``body``; ``read_time`` gives a payload's event time when
    the files are read back (columns ``body``, and those of a parquet topic).
    Payloads without a time come first.  Many payloads of one time are dealt over
    several files.
    """
    spark = payloads.sparkSession
    entries = _committed(spark, topic, write)
    if entries is None:
        # counted, sampled for the ranges and dealt: what makes the payloads runs once
        kept = payloads.persist()
        try:
            entries = _staged(kept, topic, kind, write, time_col, read_time, rows_per_file)
        finally:
            kept.unpersist()
        if not entries:
            return
        _commit(spark, topic, write, entries)
    _admit(spark, topic, entries)


def _staged(payloads: DataFrame, topic: str, kind: str, write: str, time_col: str, read_time: Column,
            rows_per_file: int) -> list[dict]:
    """The payloads written to the hidden folder; the manifest's entries of their files (none without payloads)."""
    spark = payloads.sparkSession
    total = payloads.count()
    if not total:
        return []
    files = min(FILES_A_WRITE, -(-total // rows_per_file))
    dealt = payloads.repartitionByRange(files, F.col(time_col).asc_nulls_first(), F.xxhash64("body"))
    staged = f"{topic.rstrip('/')}/{STAGING}/{write}"
    if kind == "text":
        dealt.select(F.col("body").cast("string").alias("value")).write.mode("overwrite").text(staged)
        back = spark.read.text(staged).withColumnRenamed("value", "body")
    else:
        dealt.write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(staged)
        back = spark.read.parquet(staged)
    at = F.unix_micros(read_time)
    found = (back.select(F.col("_metadata.file_name").alias("name"), at.alias("at")).groupBy("name")
             .agg(F.min("at").alias("lowest"), F.max("at").alias("highest"), F.count(F.lit(1)).alias("rows"),
                  F.count("at").alias("timed")).collect())
    # a file that holds payloads without a time comes first, whatever else it holds
    ranked = sorted(found, key=lambda r: (r["timed"] == r["rows"], r["lowest"] or 0, r["name"]))
    return [{"file": f"{write}-{i:06d}.{SUFFIX[kind]}", "staged": f"{write}/{r['name']}",
             "lowest": r["lowest"] if r["timed"] == r["rows"] else None, "highest": r["highest"], "rows": r["rows"],
             "write": write} for i, r in enumerate(ranked)]


def publisher(topic: str, kind: str, producer: str, time_col: str, read_time: Column, rows_per_file: int = ROWS_PER_FILE):
    """foreachBatch function that publishes each micro-batch; a repeated one is the same write."""
    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, topic, kind, f"{producer}-{batch_id:010d}", time_col, read_time, rows_per_file)
    return write


def arrange(spark: SparkSession, topic: str) -> None:
    """Stamp the admitted files in order of their lowest event time, over all writes.

    For a consumer that starts on a topic whose writes were not made in time
    order; files that a consumer has read already stay read.
    """
    lowest = manifest(spark, topic).select("file", F.unix_micros("lowest").alias("at"))
    known = {r["file"]: r["at"] for r in lowest.toLocalIterator()}
    there = [n for n in _names(spark, f"{topic}/{ORDERED}") if n in known]
    if there:
        fs = _fs(spark, _path(spark, topic))
        stamps = _stamps(after=time.time_ns() // 1_000_000 - len(there) - 1)
        for name in sorted(there, key=lambda n: (known[n] is not None, known[n] or 0, n)):
            _stamp(fs, _path(spark, topic, ORDERED, name), next(stamps))


def read_since(spark: SparkSession, topic: str, kind: str, since, read_time: Column) -> DataFrame:
    """Bounded read of the payloads from time ``since`` on; the manifest tells which files to open."""
    start = F.lit(since).cast("timestamp")
    late = manifest(spark, topic).filter(F.col("highest") >= start).select("file")
    paths = [f"{topic.rstrip('/')}/{ORDERED}/{r['file']}" for r in late.toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "body string" if kind == "text" else "body binary, enqueuedTime timestamp")
    got = spark.read.text(paths).withColumnRenamed("value", "body") if kind == "text" else spark.read.parquet(*paths)
    return got.filter(read_time >= start)
