"""Alert episodes against a sequential version, for shuffled arrival."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trendstream.operators import longterm as LT
from trendstream.operators import trends as TR
from trendstream.operators import watch as W
from trendstream.plans import catalog as C
from trendstream.session import fresh_path
from trendstream.sources.topics import read_topic, write_topic
from trendstream.streaming.episodes import alert_episodes, heartbeat, rocksdb_state
from trendstream.streaming.runner import ProgressCounts, start

DAY = dt.datetime(2024, 1, 1)


def alert_rows(seed, n=400, topics=5):
    rng = random.Random(seed)
    found = {(rng.choice("abcde"[:topics]), rng.randrange(600)) for _ in range(n)}
    found |= {("hot", m) for m in range(0, 600, 2)}
    rows = [(DAY + dt.timedelta(minutes=m), DAY + dt.timedelta(minutes=m + 10), t, rng.randrange(5, 50)) for t, m in found]
    rng.shuffle(rows)
    return rows


def sequential(rows, quiet=0):
    out, last = set(), {}
    for r in sorted(rows, key=lambda r: r[0]):
        if r[2] not in last or r[0] >= last[r[2]] + dt.timedelta(seconds=quiet):
            out.add(r)
        last[r[2]] = max(last.get(r[2], r[1]), r[1])
    return out


def bodies(spark, rows):
    return TR.alert_bodies(spark.createDataFrame(rows, "windowStart timestamp, windowEnd timestamp, topic string, count long")
                           .coalesce(1))


def run(spark, topic, out, delay="11 hours", quiet=0):
    counts = ProgressCounts()
    spark.streams.addListener(counts)
    try:
        alerts = W.parsed_alerts(read_topic(spark, topic, "text", max_files_per_trigger=1))
        with rocksdb_state(spark):
            q = start(alert_episodes(alerts, quiet, delay), sink="parquet", path=out, checkpoint=out + ".chk")
        counts.complete(q)
    finally:
        spark.streams.removeListener(counts)
    return counts, q


def result(spark, out):
    return {(r.windowStart, r.windowEnd, r.topic, r["count"]) for r in spark.read.parquet(out).collect()}


def test_episodes_of_shuffled_alerts_and_a_restart(spark):
    rows = alert_rows(1)
    topic, out = fresh_path(spark, "topic-alerts"), fresh_path(spark, "episodes")
    for i in range(0, len(rows), 120):
        write_topic(bodies(spark, rows[i:i + 120]), topic, "text")
    counts, q = run(spark, topic, out, quiet=300)
    assert len(counts.received(q)) >= 4 and counts.dropped(q) == 0
    # a repeated delivery, then event time goes on: the restarted query finishes from its state
    write_topic(bodies(spark, rows[:50]).unionByName(heartbeat(spark, DAY + dt.timedelta(days=3))), topic, "text")
    counts, q = run(spark, topic, out, quiet=300)
    got = spark.read.parquet(out)
    assert result(spark, out) == sequential(rows, 300) and got.count() == len(sequential(rows, 300))
    assert counts.dropped(q) == 0


def test_episode_query_takes_a_shuffled_topic_in_ten_batches(spark):
    topic, span, last = C._shuffled_alerts_topic(spark, SF_SMALL, 2)
    alerts = C._raised_alerts(spark, SF_SMALL, 2)
    assert read_topic(spark, topic, "text", stream=False).count() == alerts.count() > 100
    assert len(read_topic(spark, topic, "text", stream=False).inputFiles()) >= 10
    out = C._run_episodes(spark, topic, span, last)
    assert result(spark, out) == {tuple(r) for r in LT.new_alerts(alerts).collect()}


def test_topics_that_are_over_keep_no_state(spark):
    topic, out = fresh_path(spark, "topic-alerts"), fresh_path(spark, "episodes")
    write_topic(bodies(spark, alert_rows(2, 60)), topic, "text")
    write_topic(heartbeat(spark, DAY + dt.timedelta(days=5)), topic, "text")
    write_topic(heartbeat(spark, DAY + dt.timedelta(days=9)), topic, "text")
    counts, q = run(spark, topic, out)
    assert result(spark, out) == sequential(alert_rows(2, 60))
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 0


def test_running_baseline_equals_a_sequential_one(spark):
    """Counts of shuffled arrival over several micro-batches, a silent time included."""
    from trendstream.streaming.baseline import Baseline, running_baseline, step
    rows = alert_rows(7, 200)
    rows += [(a + dt.timedelta(days=2), b + dt.timedelta(days=2), t, n + 3) for a, b, t, n in rows[:60]]
    random.Random(1).shuffle(rows)
    topic, out = fresh_path(spark, "topic-counts"), fresh_path(spark, "baseline")
    for i in range(0, len(rows), 150):
        write_topic(bodies(spark, rows[i:i + 150]), topic, "text")
    write_topic(heartbeat(spark, DAY + dt.timedelta(days=9)), topic, "text")
    counts = ProgressCounts()
    spark.streams.addListener(counts)
    try:
        parsed = W.parsed_alerts(read_topic(spark, topic, "text", max_files_per_trigger=1))
        with rocksdb_state(spark):
            q = start(running_baseline(parsed, 0.3, 86400, "4 days"), sink="parquet", path=out, checkpoint=out + ".chk")
        counts.complete(q)
    finally:
        spark.streams.removeListener(counts)
    want, state = {}, {}
    for a, b, t, n in sorted(rows):
        mean, variance, end = state.get(t, (None, None, None))
        if mean is None or a >= end + dt.timedelta(days=1):
            want[t, a], state[t] = (n, None, None), (float(n), 0.0, b)
        else:
            want[t, a] = (n, mean, (n - mean) / variance ** 0.5 if variance > 0 else None)
            state[t] = (*step(mean, variance, 0.3, n), max(b, end))
    got = {(r.topic, r.windowStart): (r["count"], r.baseline_avg, r.z) for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k] or all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-9) for x, y in zip(got[k], want[k]))
    assert sum(v[1] is None for v in want.values()) > len(state) and isinstance(Baseline().until((1.0, 0.0, 5)), int)
