"""Roll-ups kept up by batches, and the dictionary join with heavy entities."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trendstream.functions import entities as EN
from trendstream.operators import enrich as ER
from trendstream.operators import longterm as LT
from trendstream.operators import rollup as RU
from trendstream.session import fresh_path


def topic_rows(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 70)), rng.choice(["hot"] * 5 + [f"t{i}" for i in range(30)]))
            for _ in range(n)] + [(None, "no time")]
    return spark.createDataFrame(rows, "ts timestamp, topic string")


@pytest.mark.parametrize("unit", ["week", "month"])
def test_rollup_equals_the_report_over_all_rows(spark, unit):
    path, batches = fresh_path(spark, "rollup"), [topic_rows(spark, i) for i in range(4)]
    write = RU.batch_writer(path)
    for i in (0, 1, 2, 1, 3, 3):                               # some delivered again
        write(batches[i], i)
    RU.batch_writer(path, "other")(topic_rows(spark, 9), 0)    # a second stream
    every = topic_rows(spark, 9)
    for b in batches:
        every = every.unionByName(b)
    got = sorted(map(tuple, RU.top_topics(spark, path, unit, 3).collect()))
    want = sorted(map(tuple, LT.period_top_topics(every.where("ts IS NOT NULL").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")), unit, 3).select("period", "topic", "count", "rank").collect()))
    assert got == want


def test_rollup_bounds_prune_days(spark):
    path = fresh_path(spark, "rollup")
    RU.batch_writer(path)(topic_rows(spark, 1), 0)
    some = RU.counts(spark, path, since="2024-02-01", until="2024-02-08")
    assert {r.Day for r in some.collect()} <= {dt.date(2024, 2, d) for d in range(1, 8)}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Day" in plan


def test_only_heavy_entities_are_replicated(spark, monkeypatch):
    monkeypatch.setattr(ER, "HEAVY_ROWS", 100)
    rng = random.Random(4)
    rows = [(i, "Hot" if i % 3 == 0 else f"Name{rng.randrange(400):03}") for i in range(1500)] + [(9000 + i, "Hot") for i in range(300)] \
        + [(20000, None)]
    cand = spark.createDataFrame(rows, "doc_id long, entity string")
    dictionary = spark.createDataFrame([("Hot",)] + [(f"Name{i:03}",) for i in range(0, 400, 2)], "entity string")
    heavy = ER.heavy_entities(cand)
    assert [r.entity for r in heavy.collect()] == ["Hot"]
    assert ER.replicas(dictionary, heavy).count() == dictionary.count() + ER.JOIN_SALTS - 1 < 2 * dictionary.count()
    got = {r.doc_id: r.entities for r in ER.tag_entities(cand, dictionary, candidate_rows=cand, broadcast_max_bytes=0).collect()}
    known = {r.entity for r in dictionary.collect()}
    assert got == {i: [e] if e in known else ["None"] for i, e in rows}


def test_a_literal_gazetteer_has_a_size_bound(monkeypatch):
    monkeypatch.setattr(EN, "LITERAL_MAX_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        EN.gazetteer_entities("text", ["twelve bytes"])
