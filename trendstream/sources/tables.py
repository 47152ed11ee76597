"""Parquet tables of a data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


# Scans of at least so many splits are never shuffled to spread them.
MAX_SPLITS = 64


def _parallelism(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: no SparkContext
        return None


def _row_groups(df: DataFrame, enough: int) -> int:
    """Row groups of the files of a parquet scan, counted up to ``enough``: a split without one of its own reads nothing.

    Footers are read for fewer than ``enough`` files only, as each has a row group.
    """
    files, spark = df.inputFiles(), df.sparkSession
    if not files or len(files) >= enough:      # no scan of files, or a row group in each of many
        return enough
    jvm, conf, found = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for f in files:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, conf))
        try:
            found += reader.getRowGroups().size()
        finally:
            reader.close()
    return min(found, enough)


def balance(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread an under-partitioned scan over the cluster.

    A scan of ``MAX_SPLITS`` splits or more is left alone on any cluster (no
    shuffle).  One with fewer splits than that and than the default parallelism
    (a small file, large row groups) would run all per-row work in a few
    tasks, so it is split round-robin: even whatever the values (a key with many
    copies cannot pile up), and deterministic on retry through Spark's local
    sort before the split, which is cheap for so few splits.  A
    ``key`` hash-partitions instead, when a later stage wants that layout.
    Filters and column pruning are still pushed below the repartition.
    """
    target = _parallelism(df.sparkSession)
    if not target:
        return df
    target = min(target, MAX_SPLITS)
    try:
        n = df.rdd.getNumPartitions()
    except Exception:
        return df
    if n >= target:
        try:
            n = _row_groups(df, target)
        except Exception:  # not a scan of parquet files
            return df
    if n >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def read_table(spark: SparkSession, sf_dir: str, name: str, balanced: bool = True) -> DataFrame:
    """One table of the data folder; column pruning and filters reach the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balance(df) if balanced else df


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A table folder (or single parquet file) as a streaming file source.

    The schema comes from the table footer; a single file is addressed by a
    one-file glob because the file source expects a folder.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if not os.path.isdir(path) and "://" not in path:
        path = f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)
