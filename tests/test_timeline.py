"""Topics in event-time order, jobs under a limit, and strict alert payloads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trendstream.functions import codec
from trendstream.operators import watch as W
from trendstream.plans import catalog as C
from trendstream.plans import fixtures as FX
from trendstream.session import fresh_path
from trendstream.sources import timeline as TL
from trendstream.sources.topics import read_topic
from trendstream.streaming import jobs as J
from trendstream.streaming.runner import ProgressCounts

DAY = dt.datetime(2024, 1, 1)


def payloads(spark, minutes):
    rows = [(f"{m}|{i}", None if m is None else DAY + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, "body string, at timestamp").repartition(3)


def body_time():
    m = F.substring_index("body", "|", 1).try_cast("int")
    return F.lit(DAY).cast("timestamp") + F.make_interval(mins=m)


def publish(df, topic, write, rows_per_file=10):
    TL.publish(df, topic, "text", write, "at", body_time(), rows_per_file)


def stamped(spark, topic):
    """Names of the admitted files in the order a file source takes them."""
    at = TL._path(spark, topic, TL.ORDERED)
    files = TL._fs(spark, at).listStatus(at)
    return [n for _, n in sorted((f.getModificationTime(), f.getPath().getName()) for f in files
                                 if not f.getPath().getName().startswith("."))]


def test_files_are_admitted_in_time_order(spark):
    topic = fresh_path(spark, "timeline")
    publish(payloads(spark, [(7 * i) % 100 for i in range(100)]), topic, "w1")
    files = {r["file"]: r for r in TL.manifest(spark, topic).collect()}
    order = [files[n] for n in stamped(spark, topic)]
    assert len(order) >= 8 and sum(r["rows"] for r in order) == 100
    assert all(a["highest"] <= b["lowest"] for a, b in zip(order, order[1:]))
    assert read_topic(spark, topic, "text", stream=False).count() == 100


def test_repeated_and_broken_writes(spark):
    topic = fresh_path(spark, "timeline")
    publish(payloads(spark, range(50)), topic, "w1")
    publish(payloads(spark, range(50)), topic, "w1")                       # the same write again
    assert read_topic(spark, topic, "text", stream=False).count() == 50
    # staged without a manifest: nobody reads it, and the write can be made again
    payloads(spark, range(30)).select("body").write.text(f"{topic}/{TL.STAGING}/w2")
    assert read_topic(spark, topic, "text", stream=False).count() == 50
    publish(payloads(spark, range(50, 80)), topic, "w2")
    assert read_topic(spark, topic, "text", stream=False).count() == 80
    # committed but only partly admitted: the repeated write finishes it
    last = TL._path(spark, topic, TL.ORDERED, sorted(n for n in stamped(spark, topic) if n.startswith("w2"))[-1])
    entry = next(e for e in TL._committed(spark, topic, "w2") if e["file"] == last.getName())
    TL._fs(spark, last).rename(last, TL._path(spark, topic, TL.STAGING, entry["staged"]))
    assert read_topic(spark, topic, "text", stream=False).count() < 80
    publish(payloads(spark, range(50, 80)), topic, "w2")
    assert read_topic(spark, topic, "text", stream=False).count() == 80


def test_one_hot_time_and_payloads_without_time(spark):
    topic = fresh_path(spark, "timeline")
    publish(payloads(spark, [5] * 60 + [None] * 20 + [1, 9]), topic, "w")
    files = {r["file"]: r for r in TL.manifest(spark, topic).collect()}
    assert sum(r["rows"] for r in files.values()) == 82
    assert max(r["rows"] for r in files.values()) < 40                     # the hot time is dealt over files
    order = stamped(spark, topic)
    assert files[order[0]]["lowest"] is None
    publish(payloads(spark, []), topic, "none")
    assert TL.manifest(spark, topic).count() == len(files)


def test_arrange_orders_writes_made_out_of_order(spark):
    topic = fresh_path(spark, "timeline")
    for write, first in (("late", 500), ("early", 0), ("middle", 250)):
        publish(payloads(spark, range(first, first + 40)), topic, write)
    TL.arrange(spark, topic)
    writes = [n.split("-")[0] for n in stamped(spark, topic)]
    assert writes == sorted(writes, key=["early", "middle", "late"].index)


def test_read_since_opens_only_later_files(spark):
    topic = fresh_path(spark, "timeline")
    publish(payloads(spark, range(100)), topic, "w")
    got = TL.read_since(spark, topic, "text", DAY + dt.timedelta(minutes=70), body_time())
    assert got.count() == 30 and len(got.inputFiles()) < 8
    assert TL.read_since(spark, topic, "text", DAY + dt.timedelta(days=9), body_time()).isEmpty()


def test_alert_job_is_the_same_with_one_file_a_micro_batch(spark):
    got = {}
    for limit in (None, 1):
        cfg = C._limited_pipeline(spark, SF_SMALL, rows_per_file=200, parts=3)
        cfg.max_files_per_trigger = limit
        counts = ProgressCounts()
        spark.streams.addListener(counts)
        try:
            q = J.alerts_job(spark, cfg)
            counts.complete(q)
        finally:
            spark.streams.removeListener(counts)
        assert counts.dropped(q) == 0
        assert limit is None or len(counts.received(q)) >= 5
        got[limit] = sorted(tuple(r) for r in W.parsed_alerts(cfg.read(spark, cfg.alerts_topic, stream=False)).collect())
    assert got[None] == got[1] and got[1]


def test_dropped_rows_are_an_error(spark):
    """Files admitted against event time, without arranging them: the run says so."""
    cfg = J.PipelineConfig(root=fresh_path(spark, "late"), max_files_per_trigger=1, threshold=1, rows_per_file=200)
    posts = FX.event_posts(spark, SF_SMALL)
    half = F.col("created_at") < "2024-01-15"
    J.ingest_job(posts.where(~half), cfg, time_col="created_at")
    J.enrichment_job(spark, cfg).awaitTermination()
    counts = ProgressCounts()
    spark.streams.addListener(counts)
    try:
        counts.complete(J.alerts_job(spark, cfg))
        J.ingest_job(posts.where(half), cfg, time_col="created_at")
        J.enrichment_job(spark, cfg).awaitTermination()
        with pytest.raises(RuntimeError, match="too late"):
            counts.complete(J.alerts_job(spark, cfg))
    finally:
        spark.streams.removeListener(counts)


ALERT = '{"windowStart":"2024-01-15 00:00:00","windowEnd":"2024-01-15 00:10:00","topic":"t","count":7}'


@pytest.mark.parametrize("body,good", [
    (ALERT, True), (f" \n{ALERT}\t", True), (ALERT + " and more", False), (ALERT + ALERT, False), (ALERT + "," + ALERT, False),
    (ALERT + "] x", False), (ALERT + "]", False), (ALERT + "}", False), (ALERT + '}, "b": {', False), (ALERT + ', "b": 1', False),
    (ALERT[:-12], False), (f"[{ALERT}]", False), ("x " + ALERT, False), ('"text"', False), ("7", False), ("null", False), ("", False),
    (None, False), (ALERT.replace('"t"', '"brace } ] {"'), True)])
def test_a_payload_is_one_whole_object(spark, body, good):
    df = spark.createDataFrame([(body,)], "body string")
    assert df.select(codec.one_json_object("body")).first()[0] is good
    assert (W.parsed_alerts(df).count() == 1) is good
    assert W.rejected_payloads(df).first()["rejected"] == (0 if good else 1)
