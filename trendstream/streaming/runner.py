"""Start, run and wait for streaming queries.

Every query gets a checkpoint: a restarted query resumes from its offsets
and state instead of re-reading or losing rows.  Two run kinds:

* ``once``: process everything available now, then stop (availableNow);
* ``continuous``: a processing-time trigger; returns the running query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def start(df: DataFrame, *, sink: str, checkpoint: str, path: str | None = None,
          mode: str = "once", output_mode: str = "append", interval: str = "10 seconds",
          query_name: str | None = None, options: dict | None = None,
          foreach_batch=None, partition_by: list[str] | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start ``df`` towards ``sink`` (parquet, json, text, kafka, memory, console, foreachBatch).

    A new checkpoint gets at most ``state_partitions`` partitions of state (and of shuffles): where a
    micro-batch is bounded, more of them only add files to every commit.  An older one keeps its own.
    """
    if not checkpoint:
        raise ValueError("every streaming query needs a checkpoint location")
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path is not None:
            w = w.option("path", path)
    if mode == "once":
        w = w.trigger(availableNow=True)
    elif mode == "continuous":
        w = w.trigger(processingTime=interval)
    else:
        raise ValueError(f"unknown run kind {mode!r}")
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_PARTITIONS)
    if state_partitions is not None:
        conf.set(SHUFFLE_PARTITIONS, str(min(state_partitions, int(before))))
    try:
        return w.start()   # the query runs on a copy of the session's settings
    finally:
        conf.set(SHUFFLE_PARTITIONS, before)


def run_once(df: DataFrame, **kw) -> StreamingQuery:
    """Start with ``mode='once'`` and wait until all available input is processed."""
    q = start(df, mode="once", **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


class ProgressCounts(StreamingQueryListener):
    """Input rows of each micro-batch, rows dropped as late and most rows in state, of every batch of a query.

    (``recentProgress`` forgets all but the last batches.)  Attach it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self.batches: dict[str, list[tuple[int, int, int]]] = {}

    def onQueryStarted(self, event):
        self.batches.setdefault(str(event.id), [])

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.setdefault(str(p.id), []).append(
            (p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
             sum(s.numRowsTotal for s in p.stateOperators)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def received(self, q: StreamingQuery) -> list[int]:
        return [b[0] for b in self.batches.get(str(q.id), []) if b[0]]

    def dropped(self, q: StreamingQuery) -> int:
        return sum(b[1] for b in self.batches.get(str(q.id), []))

    def complete(self, q: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait for a bounded run and its progress; rows that were dropped as late are an error."""
        import time
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        last, end = q.lastProgress, time.monotonic() + seconds
        want = len({p["batchId"] for p in q.recentProgress}) if last else 0
        while len(self.batches.get(str(q.id), [])) < want and time.monotonic() < end:
            time.sleep(0.05)
        if self.dropped(q):
            raise RuntimeError(f"{self.dropped(q)} rows came too late and were dropped")

    def most_state(self, q: StreamingQuery) -> int:
        return max((b[2] for b in self.batches.get(str(q.id), [])), default=0)


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    """Rows the stateful operators dropped as late, over the last 100 micro-batches (see ``ProgressCounts``)."""
    total = 0
    for p in q.recentProgress:
        for s in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (s.get("numRowsDroppedByWatermark", 0) if isinstance(s, dict)
                      else s.numRowsDroppedByWatermark)
    return total


def rows_received(q: StreamingQuery) -> list[int]:
    """Input rows of the last 100 micro-batches (see ``ProgressCounts``)."""
    return [(p["numInputRows"] if isinstance(p, dict) else p.numInputRows) for p in q.recentProgress]
