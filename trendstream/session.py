"""Session helpers.

On a cluster the session is built by the platform; we only read from it.
``shared_dir`` returns the folder named by ``spark.checkpoint.dir`` (a
shared file system on a cluster) and sets a local one only when the
setting is absent, which is the case in tests and the local bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on.  The time zone is pinned because
# timestamps travel as strings between stages (enriched JSON, alerts).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Generate adds size(entities) > 0 filters that re-run from_json on the scan
# side; the explode already drops empty arrays, so the rule only costs extra
# JSON parses.  It joins the rules the user has excluded.
EXCLUDED_RULES = "spark.sql.optimizer.excludedRules"
NO_GENERATE_FILTERS = "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate"
TIME_ZONE = "spark.sql.session.timeZone"
# Shuffle files go at the end of their query, not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows sent to a Python worker at once, by their size: a batch is held by the task, the worker and its lists.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXT_BATCH = 2 << 20


# State store for large streaming state (off-heap, incremental checkpoints).
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "trendstream", extra: dict | None = None,
                  state_store: str | None = None) -> SparkSession:
    """Session for tests, scripts and the bench (never used on a cluster).

    ``state_store="rocksdb"`` selects the RocksDB provider, the choice for
    state that outgrows executor heaps; small local runs keep Spark's default.
    """
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # Small local inputs: keep post-shuffle partitions from collapsing
         # into one task (cluster sessions keep their own setting).
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB"))
    if state_store == "rocksdb":
        b = b.config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_core_conf(spark)


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings on some platforms
            if k == TIME_ZONE and spark.conf.get(k) != v:  # results depend on it
                raise
    rules = [r for r in (spark.conf.get(EXCLUDED_RULES, None) or "").split(",") if r.strip()]
    if NO_GENERATE_FILTERS not in rules:
        spark.conf.set(EXCLUDED_RULES, ",".join([*rules, NO_GENERATE_FILTERS]))
    return spark


def bound_batches(spark: SparkSession, most: int = TEXT_BATCH) -> None:
    """Rows of whole texts reach Python workers in batches of about ``most`` bytes, from now on in this session."""
    spark.conf.set(BATCH_BYTES, str(most))


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        return int(spark.conf.get("spark.sql.shuffle.partitions", str(fallback)))


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints, stream topics and written tables.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset and
    the master is local (tests) a local folder is chosen and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d and (sc is None or not re.match(r"local(\[|$)", sc.master)):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = os.environ.get("TRENDSTREAM_LOCAL_DIR") or tempfile.mkdtemp(prefix="trendstream-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unused sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex[:12]}"


def materialize(df, kind: str = "stage"):
    """Write ``df`` once as parquet into the shared folder and read it back.

    Cuts the lineage (a lost executor does not recompute the source), keeps
    computed columns fixed (ids, positions), and is reused by every consumer
    of the result.  Columnar and compressed, so cheaper than an RDD checkpoint.
    What the write has shuffled is not read again, and is freed with its end.
    """
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def discard(written: DataFrame) -> None:
    """Delete the files of a frame made by ``materialize`` that nothing reads any more."""
    spark = written.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in written.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_SHIPPED: set = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (pandas UDFs,
    mapInPandas, applyInPandasWithState), once per application.

    The package is zipped on the driver and added with ``addPyFile``; Spark
    serves it to every executor.  Deployments that already ship it with
    ``--py-files`` lose nothing but a second copy.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship with spark.addArtifacts instead
        return
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        _ship(sc)
        _SHIPPED.add(app)


def _ship(sc) -> None:
    import io
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    path = os.path.join(tempfile.mkdtemp(prefix="trendstream-code-"), "trendstream.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    try:
        sc.addPyFile(path)
    except Exception as e:  # registered earlier in this application (another session object)
        if "already registered" not in str(e):
            raise
