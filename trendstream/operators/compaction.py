"""Compaction of the history table behind a snapshot pointer.

Every micro-batch adds a partition of a few small files to each date it has rows
of.  ``compact`` rewrites the dates that have such partitions into at most
``files_per_date`` files and then writes a pointer: which folder holds each date's
compacted rows, and which partitions they cover.  A reader takes the newest
pointer and reads the compacted folders and the partitions that it does not
cover, so it sees each row once at any time: before the pointer appears
everything by the partitions, afterwards the same rows by the compacted folders.

Nothing is deleted at once.  ``expire`` removes partitions and folders that the
pointer before the newest one had replaced already, so a reader that began before
the last compaction still finds its files.  A micro-batch that is repeated after
it was covered rewrites a covered partition, which nobody reads.  The newest
batch of each stream is left alone, as it may be repeated or still be written.
One compaction runs at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOTS = "_snapshots"
FILES_PER_DATE = 8
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _fs(spark: SparkSession, location: str):
    return _path(spark, location).getFileSystem(spark._jsc.hadoopConfiguration())


def _list(spark: SparkSession, *parts: str) -> list[str]:
    at, fs = _path(spark, *parts), _fs(spark, parts[0])
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def partitions(spark: SparkSession, location: str) -> list[tuple[str, str]]:
    """(date, writer) of the partitions in the folder, as their folders name them."""
    dates = [d.partition("=")[2] for d in _list(spark, location) if d.startswith("TweetDate=")]
    return [(d, w.partition("=")[2]) for d in dates for w in _list(spark, location, f"TweetDate={d}") if w.startswith("Writer=")]


def _pointers(spark: SparkSession, location: str) -> list[str]:
    return [n for n in _list(spark, location, SNAPSHOTS) if re.fullmatch(r"pointer-\d{9}\.json", n)]


def _load(spark: SparkSession, location: str, name: str) -> dict:
    text = spark.read.text(f"{location}/{SNAPSHOTS}/{name}", wholetext=True).first()["value"]
    found = json.loads(text)
    return {"dates": found["dates"], "covers": {tuple(c) for c in found["covers"]}}


def snapshot(spark: SparkSession, location: str) -> dict:
    """The newest pointer: dates (date -> folder of its compacted rows) and covers (set of partitions)."""
    known = _pointers(spark, location)
    return _load(spark, location, known[-1]) if known else {"dates": {}, "covers": set()}


def _point(spark: SparkSession, location: str, dates: dict, covers: set) -> None:
    known = _pointers(spark, location)
    number = int(known[-1][8:17]) + 1 if known else 1
    at, beside = (_path(spark, location, SNAPSHOTS, f"{p}pointer-{number:09d}.json") for p in ("", "."))
    fs = _fs(spark, location)
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps({"dates": dates, "covers": sorted(covers)}).encode()))
    out.close()
    if not fs.rename(beside, at):
        raise OSError(f"{at.toString()} could not be written: is another compaction running?")


def _newest_batches(writers: set[str]) -> set[str]:
    """The last batch of each stream (writers named ``<stream>-<number>``)."""
    last: dict[str, int] = {}
    for w in writers:
        stream, _, number = w.rpartition("-")
        if number.isdigit():
            last[stream] = max(last.get(stream, -1), int(number))
    return {f"{s}-{n}" for s, n in last.items()}


def _rows(spark: SparkSession, location: str, folders: dict[str, str], parts: list[tuple[str, str]]) -> DataFrame | None:
    """Rows of compacted folders (date -> folder) and of partitions, without Writer."""
    found = []
    for base in sorted(set(folders.values())):
        paths = [f"{base}/TweetDate={d}" for d, b in sorted(folders.items()) if b == base]
        found.append(spark.read.option("basePath", base).parquet(*paths))
    if parts:
        found.append(spark.read.option("basePath", location).parquet(
            *[f"{location}/TweetDate={d}/Writer={w}" for d, w in parts]).drop("Writer"))
    # a partition column of null dates alone has no type of its own
    found = [f.withColumn("TweetDate", F.col("TweetDate").cast("date")) for f in found]
    return reduce(DataFrame.unionByName, found) if found else None


def compact(spark: SparkSession, location: str, files_per_date: int = FILES_PER_DATE) -> int:
    """Rewrite the dates with uncovered partitions; the number of partitions that are covered now and were not before."""
    location = location.rstrip("/")
    now, there = snapshot(spark, location), partitions(spark, location)
    young = _newest_batches({w for _, w in there})
    fresh = [p for p in there if p not in now["covers"] and p[1] not in young]
    if not fresh:
        return 0
    dates = sorted({d for d, _ in fresh})
    rows = _rows(spark, location, {d: now["dates"][d] for d in dates if d in now["dates"]}, fresh)
    base = f"{location}/{SNAPSHOTS}/data-{uuid.uuid4().hex}"
    salt = F.pmod(F.xxhash64("UniqueId", "Topic"), F.lit(files_per_date))
    rows.repartition(F.col("TweetDate"), salt).write.partitionBy("TweetDate").parquet(base)
    # partitions that are gone need no cover any more
    covers = (now["covers"] & set(there)) | set(fresh)
    _point(spark, location, {**now["dates"], **{d: base for d in dates}}, covers)
    return len(fresh)


def expire(spark: SparkSession, location: str) -> int:
    """Delete partitions that the last pointer but one covers, folders and pointers older than it; the number of partitions."""
    location = location.rstrip("/")
    known = _pointers(spark, location)
    if len(known) < 2:
        return 0
    before, now = (_load(spark, location, n) for n in known[-2:])
    fs = _fs(spark, location)
    gone = [p for p in partitions(spark, location) if p in before["covers"] and p in now["covers"]]
    for d, w in gone:
        fs.delete(_path(spark, location, f"TweetDate={d}", f"Writer={w}"), True)
    used = {f.rpartition("/")[2] for s in (before, now) for f in s["dates"].values()}
    for name in _list(spark, location, SNAPSHOTS):
        if name.startswith("data-") and name not in used or name in known[:-2]:
            fs.delete(_path(spark, location, SNAPSHOTS, name), True)
    return len(gone)


def read(spark: SparkSession, location: str, since=None, until=None) -> DataFrame | None:
    """Every row once (without Writer), of the dates from ``since`` up to ``until`` (text, yyyy-MM-dd...); None without any."""
    location = location.rstrip("/")
    def asked(d: str) -> bool:
        if since is None and until is None:
            return True
        return d != NO_DATE and (since is None or d >= str(since)[:10]) and (until is None or d < str(until)[:10])
    # the partitions first: one that a later pointer covers is then read by the pointer taken before or after, never twice
    there = partitions(spark, location)
    now = snapshot(spark, location)
    return _rows(spark, location, {d: f for d, f in now["dates"].items() if asked(d)},
                 [p for p in there if p not in now["covers"] and asked(p[0])])
