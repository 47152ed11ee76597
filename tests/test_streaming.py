"""Structured Streaming behaviour: stream == batch, late data, restarts, two consumers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trendstream.operators import history as H
from trendstream.operators import trends as TR
from trendstream.operators import watch as W
from trendstream.plans import catalog as C
from trendstream.plans import fixtures as FX
from trendstream.session import fresh_path
from trendstream.sources.tables import read_table
from trendstream.sources.topics import producer_path, read_topic, write_topic
from trendstream.streaming import pipelines as P
from trendstream.streaming.runner import rows_dropped_by_watermark, rows_received, run_once, start


def _batch_closed(spark, threshold=1):
    rows = C._topic_rows(spark, SF_SMALL)
    return TR.threshold(TR.closed_windows(TR.topic_counts(rows), rows), threshold)


def _as_set(df):
    return {(r.windowStart, r.windowEnd, r.topic, r["count"]) for r in df.collect()}


def test_stream_equals_batch_closed_windows_and_late_rows_are_dropped(spark):
    topic = C._enriched_topic(spark, SF_SMALL)
    out = fresh_path(spark, "counts")
    q1 = C._run_alert_stream(spark, topic, out, 1)
    first = _as_set(C._read_alert_sink(spark, out))
    assert first == _as_set(_batch_closed(spark))
    late = FX.enriched_events(spark, SF_SMALL).orderBy("timestamp").limit(C.LATE_REDELIVERED)
    write_topic(P.enriched_bodies(late), topic, "text")
    q2 = C._run_alert_stream(spark, topic, out, 1)
    assert _as_set(C._read_alert_sink(spark, out)) == first
    assert sum(rows_received(q2)) == C.LATE_REDELIVERED
    assert rows_dropped_by_watermark(q2) > 0
    assert rows_dropped_by_watermark(q1) == 0


def test_restart_from_checkpoint_adds_nothing(spark):
    topic = C._enriched_topic(spark, SF_SMALL)
    n = read_topic(spark, topic, "text", stream=False).count()
    ev = read_table(spark, SF_SMALL, "events", balanced=False)
    assert n == ev.count()
    # same checkpoint, same source: the second run finds no new input
    from trendstream.sources.tables import stream_table
    bodies = P.enriched_bodies(FX.enriched_from_events(stream_table(spark, SF_SMALL, "events")))
    topic = fresh_path(spark, "topic-restart")
    for again in (False, True):
        q = run_once(bodies.select(F.col("body").alias("value")), sink="text",
                     path=producer_path(topic, "enrich"), checkpoint=topic + ".chk")
        assert sum(rows_received(q)) == (0 if again else n)
        assert read_topic(spark, topic, "text", stream=False, producers=("enrich",)).count() == n


def test_history_replay_is_bounded_and_order_safe(spark):
    """Slices of event time, one per micro-batch: nothing is late and state never
    holds more than a part of the history's windows."""
    from trendstream.streaming.runner import ProgressCounts
    counts = ProgressCounts()
    spark.streams.addListener(counts)
    try:
        topic, out = C._enriched_topic(spark, SF_SMALL), fresh_path(spark, "counts")
        q = C._run_alert_stream(spark, topic, out, 1)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        import time
        for _ in range(50):
            if len(counts.received(q)) >= C.SLICES:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counts)
    windows = _batch_closed(spark).count()
    assert len(counts.received(q)) >= 4 and counts.dropped(q) == 0
    assert counts.most_state(q) < windows / 2
    assert _as_set(C._read_alert_sink(spark, out)) == _as_set(_batch_closed(spark))


def test_multi_batch_stream_in_time_order(spark):
    """Topic files written in time order, one file per trigger: the watermark
    advances batch by batch and the result still equals the batch answer."""
    enriched = FX.enriched_events(spark, SF_SMALL)
    topic = fresh_path(spark, "topic-slices")
    bounds = [r.d for r in enriched.select(F.to_date("timestamp").alias("d")).distinct()
              .orderBy("d").collect()]
    for lo, hi in zip(bounds[::7], bounds[7::7] + [bounds[-1] + dt.timedelta(days=1)]):
        part = enriched.where((F.to_date("timestamp") >= lo) & (F.to_date("timestamp") < hi))
        write_topic(P.enriched_bodies(part).coalesce(1), topic, "text")
    out = fresh_path(spark, "counts")
    q = run_once(P.alerts(read_topic(spark, topic, "text", max_files_per_trigger=1), 1),
                 sink="parquet", path=out, checkpoint=out + ".chk")
    assert len([n for n in rows_received(q) if n > 0]) >= 4
    assert rows_dropped_by_watermark(q) == 0
    assert _as_set(C._read_alert_sink(spark, out)) == _as_set(_batch_closed(spark))


def test_two_consumers_of_one_topic(spark):
    topic = C._enriched_topic(spark, SF_SMALL)
    hist_loc, alerts_loc = fresh_path(spark, "history"), fresh_path(spark, "alerts")
    qh = H.start_stream(P.history(read_topic(spark, topic, "text")), hist_loc, hist_loc + ".chk")
    qa = start(P.alert_bodies(P.alerts(read_topic(spark, topic, "text"), 2)).select(
        F.col("body").alias("value")), sink="text", path=producer_path(alerts_loc, "alerts"),
        checkpoint=alerts_loc + ".chk")
    qh.awaitTermination()
    qa.awaitTermination()
    events = read_table(spark, SF_SMALL, "events").count()
    assert H.read_history(spark, hist_loc).count() == 2 * events
    alerts = read_topic(spark, alerts_loc, "text", stream=False, producers=("alerts",))
    expected = _batch_closed(spark, 2).count()
    assert W.parsed_alerts(alerts).count() == expected > 0
    assert W.wait_for(lambda: read_topic(spark, alerts_loc, "text", stream=False, producers=("alerts",)),
                      "2024-01-01 00:00:00", deadline_minutes=0)


def test_continuous_run_and_memory_sink(spark):
    topic = C._enriched_topic(spark, SF_SMALL)
    chk = fresh_path(spark, "mem")
    q = start(P.alerts(read_topic(spark, topic, "text"), 2), sink="memory", checkpoint=chk,
              mode="continuous", interval="1 second", query_name="alerts_view")
    try:
        q.processAllAvailable()
        got = _as_set(spark.table("alerts_view"))
    finally:
        q.stop()
    assert got == _as_set(_batch_closed(spark, 2))


def test_stream_new_alerts_equals_batch_on_closed_alerts(spark):
    got = _as_set(C.stream_new_alerts(spark, SF_SMALL))
    from trendstream.operators import longterm as LT
    expected = _as_set(LT.new_alerts(_batch_closed(spark, TR.ALERT_THRESHOLD)))
    assert got == expected


def test_rocksdb_state_store_gives_the_same_alerts(spark):
    from trendstream.session import ROCKSDB_PROVIDER
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        topic = C._enriched_topic(spark, SF_SMALL)
        out = fresh_path(spark, "counts-rocksdb")
        C._run_alert_stream(spark, topic, out, 2)
        got = _as_set(C._read_alert_sink(spark, out))
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
    assert got == _as_set(_batch_closed(spark, 2))


def test_foreach_batch_history_writer_is_idempotent(spark):
    topic = C._enriched_topic(spark, SF_SMALL)
    loc = fresh_path(spark, "history-fb")
    writer = H.batch_writer(loc)
    q = run_once(P.history(read_topic(spark, topic, "text")), sink=None, checkpoint=loc + ".chk",
                 foreach_batch=writer)
    events = read_table(spark, SF_SMALL, "events").count()
    assert spark.read.parquet(loc).count() == 2 * events
    # replaying batch 0 by hand (as after a failure) replaces its folder
    first = q.recentProgress[0]["batchId"]
    writer(P.history(read_topic(spark, topic, "text", stream=False)), first)
    assert spark.read.parquet(loc).count() == 2 * events
    q2 = run_once(P.history(read_topic(spark, topic, "text")), sink=None, checkpoint=loc + ".chk",
                  foreach_batch=writer)
    assert sum(rows_received(q2)) == 0


def test_new_alert_stream_over_several_batches(spark):
    """Alerts delivered in time-ordered slices, one per trigger: state carries the
    last alert end across batches and times out behind the watermark."""
    from trendstream.operators import longterm as LT
    from trendstream.streaming.newalerts import new_alerts_stream
    alerts = _batch_closed(spark, 2)
    assert alerts.count() > 10
    topic = fresh_path(spark, "topic-alerts")
    days = sorted({r.d for r in alerts.select(F.to_date("windowStart").alias("d")).collect()})
    cuts = days[::10] + [days[-1] + dt.timedelta(days=1)]
    for lo, hi in zip(cuts, cuts[1:]):
        part = alerts.where((F.to_date("windowStart") >= lo) & (F.to_date("windowStart") < hi))
        write_topic(TR.alert_bodies(part).coalesce(1), topic, "text")
    out = fresh_path(spark, "new-alerts")
    q = run_once(new_alerts_stream(W.parsed_alerts(read_topic(spark, topic, "text", max_files_per_trigger=1))),
                 sink="parquet", path=out, checkpoint=out + ".chk")
    assert len([n for n in rows_received(q) if n > 0]) >= 3
    got = _as_set(C._read_alert_sink(spark, out))
    assert got == _as_set(LT.new_alerts(alerts)) and len(got) > 0


def test_new_alert_query_reads_its_topic_slice_by_slice(spark):
    """The registered query's own topic: several micro-batches in event time, none of its alerts dropped."""
    from trendstream.operators import longterm as LT
    alerts = _batch_closed(spark, 2)
    topic, delay = C._alerts_topic(spark, SF_SMALL, 2)
    out = fresh_path(spark, "new-alerts")
    q = C._run_new_alert_stream(spark, topic, out, delay)
    assert len([n for n in rows_received(q) if n > 0]) == C.SLICES and sum(rows_received(q)) == alerts.count()
    assert rows_dropped_by_watermark(q) == 0
    assert _as_set(C._read_alert_sink(spark, out)) == _as_set(LT.new_alerts(alerts))


def test_dropped_alerts_are_reported(spark):
    """Slices in the wrong order: what the watermark drops is an error, not silence."""
    topic = fresh_path(spark, "topic-alerts")
    for day in (20, 21, 1):           # a watermark holds for late rows one micro-batch later
        part = spark.sql(f"SELECT TIMESTAMP '2024-01-{day:02} 00:00:00' AS windowStart, "
                         f"TIMESTAMP '2024-01-{day:02} 00:10:00' AS windowEnd, 't' AS topic, 5L AS count")
        write_topic(TR.alert_bodies(part), topic, "text", files=C.FILES_A_SLICE)
    files = read_topic(spark, topic, "text", stream=False).inputFiles()
    assert len(files) == 3 * C.FILES_A_SLICE                      # one row each, yet as many files as any slice
    with pytest.raises(RuntimeError, match="1 alerts"):
        C._run_new_alert_stream(spark, topic, fresh_path(spark, "new-alerts"), "1 hour")


def test_incremental_watcher(spark):
    from trendstream.streaming.watcher import wait_for_fresh
    topic = fresh_path(spark, "topic-alerts")
    alerts = _batch_closed(spark, 2)
    old = alerts.where(F.col("windowStart") < F.lit(dt.datetime(2024, 1, 20)))
    new = alerts.where(F.col("windowStart") >= F.lit(dt.datetime(2024, 1, 20)))
    write_topic(TR.alert_bodies(old), topic, "text")
    work = fresh_path(spark, "watch")
    assert not wait_for_fresh(lambda: read_topic(spark, topic, "text"), "2024-01-20 00:00:00", work, deadline_minutes=0)
    write_topic(TR.alert_bodies(new), topic, "text")
    assert wait_for_fresh(lambda: read_topic(spark, topic, "text"), "2024-01-20 00:00:00", work, deadline_minutes=0)
