"""Properties of the window counts, checked against a brute-force count."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trendstream.operators import longterm as LT
from trendstream.operators import trends as TR
from trendstream.plans import catalog as C

BASE = dt.datetime(2024, 1, 1)
rows_strategy = st.lists(st.tuples(st.integers(0, 4 * 3600 * 10**6), st.sampled_from("abcd")),
                         min_size=1, max_size=60)


def brute_force(rows, length_min=10, slide_min=1):
    counts = collections.Counter()
    for us, topic in rows:
        t = BASE + dt.timedelta(microseconds=us)
        minute = t.replace(second=0, microsecond=0)
        for i in range(length_min // slide_min):
            start = minute - dt.timedelta(minutes=i * slide_min)
            if start <= t < start + dt.timedelta(minutes=length_min):
                counts[(start, topic)] += 1
    return counts


def _df(spark, rows):
    data = [(BASE + dt.timedelta(microseconds=us), topic) for us, topic in rows]
    return spark.createDataFrame(data, "ts timestamp_ntz, topic string")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_window_counts_equal_brute_force(spark, rows):
    got = {(r.windowStart, r.topic): r["count"] for r in TR.topic_counts(_df(spark, rows)).collect()}
    assert got == dict(brute_force(rows))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, threshold=st.integers(1, 4))
def test_alerts_are_counts_at_or_above_threshold(spark, rows, threshold):
    counts = TR.topic_counts(_df(spark, rows))
    alerts = {tuple(r) for r in TR.threshold(counts, threshold).collect()}
    all_counts = {tuple(r) for r in counts.collect()}
    assert alerts <= all_counts
    assert alerts == {r for r in all_counts if r[3] >= threshold}


def test_sum_over_windows_is_ten_times_rows(spark):
    rows = C._topic_rows(spark, SF_SMALL)
    total = TR.topic_counts(rows).agg(F.sum("count")).first()[0]
    assert total == 10 * rows.count()


def test_permuting_input_leaves_counts_alone(spark):
    rows = C._topic_rows(spark, SF_SMALL)
    shuffled = rows.orderBy(F.rand(7)).repartition(5)
    a = {tuple(r) for r in TR.topic_counts(rows).collect()}
    b = {tuple(r) for r in TR.topic_counts(shuffled).collect()}
    assert a == b


def test_top_k_two_pass_equals_single_window(spark):
    from pyspark.sql import Window
    rows = C._topic_rows(spark, SF_SMALL)
    counts = rows.groupBy(F.date_trunc("week", "ts").alias("period"), "topic").agg(
        F.count(F.lit(1)).alias("count"))
    order = [F.col("count").desc(), F.col("topic")]
    two = {tuple(r) for r in LT.top_k_per_group(counts, "period", order, 3, "topic", salts=4).collect()}
    w = Window.partitionBy("period").orderBy(*order)
    one = {tuple(r) for r in counts.withColumn("rank", F.row_number().over(w)).where("rank <= 3").collect()}
    assert two == one


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 6 * 3600), st.sampled_from("ab"), st.integers(1, 9)),
                     min_size=1, max_size=80, unique_by=lambda r: (r[0] // 60, r[1])))
def test_chunked_anomaly_equals_whole_topic_window(spark, rows):
    from pyspark.sql import Window
    data = [(BASE + dt.timedelta(minutes=m // 60), t, c) for m, t, c in rows]
    counts = spark.createDataFrame(data, "windowStart timestamp_ntz, topic string, count bigint")
    chunked = {tuple(r) for r in LT.topic_anomaly(counts, history=3, chunk_unit="hour").collect()}
    w = Window.partitionBy("topic").orderBy("windowStart").rowsBetween(-3, -1)
    avg, sd = F.avg("count").over(w), F.stddev_samp("count").over(w)
    whole = {tuple(r) for r in counts.select(
        "windowStart", "topic", "count", F.round(avg, 6), F.round(sd, 6),
        F.round(F.when(sd > 0, (F.col("count") - avg) / sd), 6)).collect()}
    assert chunked == whole
