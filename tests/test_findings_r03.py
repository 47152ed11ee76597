"""Cases of the third round's findings: what a step holds, how often it runs, and the results it must keep."""

import datetime as dt
import random

from pyspark.sql import functions as F

from trendstream.operators import trends as TR


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_windows_are_summed_before_they_are_expanded(spark):
    rnd, t0 = random.Random(5), dt.datetime(2024, 1, 1, 0, 30)
    rows = [(t0 + dt.timedelta(seconds=rnd.randrange(4 * 3600)), rnd.choice(["a", "b", None])) for _ in range(400)]
    rows += [(None, "a"), (t0, "rare"), (t0 + dt.timedelta(minutes=35), "rare")]
    want = {}
    for ts, topic in rows:
        if ts is not None:
            for i in range(10):
                start = ts.replace(second=0, microsecond=0) - dt.timedelta(minutes=i)
                want[start, topic] = want.get((start, topic), 0) + 1
    df = TR.topic_counts(spark.createDataFrame(rows, "ts timestamp_ntz, topic string"))
    got = df.collect()
    assert {(r.windowStart, r.topic): r["count"] for r in got} == want and len(got) == len(want)
    assert all(r.windowEnd - r.windowStart == dt.timedelta(minutes=10) for r in got)
    # no aggregate holds the expanded windows
    kinds = [line.strip(" +-:").split(" ")[0] for line in _plan(df)]
    assert kinds.index("Window") < kinds.index("Aggregate")


def test_texts_are_cut_once_for_all_lengths_of_entries(spark):
    from trendstream.functions import entities as EN
    texts = ["The and attion to of the the", "and attion to", "of-the", "", None, "to", "attion to the end of the"]
    names = ["the", "of the", "The and attion to", "and attion to", "attion to the end", "no  run", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    found = df.select("id", EN.gazetteer_entities("text", names).alias("e"))
    assert "\n".join(_plan(found)).count("split(") == 1
    assert {r.id: r.e for r in found.collect()} == {
        0: ["the", "of the", "and attion to", "The and attion to"], 1: ["and attion to"], 2: ["the", "of the"], 3: ["None"],
        4: ["None"], 5: ["None"], 6: ["the", "of the", "attion to the end"]}
    runs = df.select("id", EN.ngrams(EN.word_tokens("text"), 4).alias("r"))
    assert "\n".join(_plan(runs)).count("split(") == 1
    got = {r.id: r.r for r in runs.collect()}
    assert got[1] == ["and", "attion", "to", "and attion", "attion to", "and attion to"] and got[5] == ["to"]
    assert got[3] == [] and got[4] is None


def test_only_candidates_that_are_entries_travel(spark):
    from trendstream.operators import enrich as ER
    docs = spark.createDataFrame([(1, "the end"), (1, "of it"), (2, "none"), (3, None), (None, "of the")], "doc_id long, text string")
    names = spark.createDataFrame([("the",), ("of the",), ("of",), (None,)], "entity string")
    want = {1: ["of", "the"], 2: ["None"], 3: ["None"], None: ["of", "of the", "the"]}
    for at_most in (1 << 20, 0):
        tagged = ER.tag_entities(docs, names, candidates="ngrams", broadcast_max_bytes=at_most)
        assert {r.doc_id: r.entities for r in tagged.collect()} == want
        joins = [line for line in _plan(tagged) if "Join" in line and "_heavy" not in line]
        assert joins and "Join Inner" in joins[0]


def test_a_longer_history_has_larger_files_not_more_micro_batches(spark, monkeypatch):
    from trendstream.plans import catalog as C
    from trendstream.sources.timeline import manifest
    monkeypatch.setattr(C, "LIMITED_FILES", 4)
    monkeypatch.setattr(C, "LIMITED_ROWS_PER_FILE", 10)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    cfg = C._limited_pipeline(spark, "/root/testdata/sf0.001")
    for topic in (cfg.raw_topic, cfg.enriched_topic):
        files = manifest(spark, topic).collect()
        assert sum(f["rows"] for f in files) == events
        assert 4 <= len(files) <= 8


def test_published_payloads_are_made_once(spark):
    from trendstream.session import fresh_path
    from trendstream.sources import timeline as TL
    made = spark.sparkContext.accumulator(0)

    def body(i):
        made.add(1)
        return f"{i}"
    rows = spark.range(500).select(F.udf(body, "string").asNondeterministic()("id").alias("body"),
                                   F.timestamp_seconds("id").alias("at"))
    topic = fresh_path(spark, "published")
    TL.publish(rows, topic, "text", "w", "at", F.timestamp_seconds(F.col("body").cast("long")), 100)
    assert made.value == 500
    assert sum(r["rows"] for r in TL.manifest(spark, topic).collect()) == 500
    assert sorted(int(r.value) for r in spark.read.text(f"{topic}/{TL.ORDERED}").collect()) == list(range(500))


def test_splits_without_a_row_group_do_not_count_as_balanced(spark, tmp_path):
    from trendstream.sources.tables import balance
    path, keep = str(tmp_path / "one group.parquet"), {}
    spark.range(20_000).coalesce(1).write.parquet(path)
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        keep[k] = spark.conf.get(k)
        spark.conf.set(k, "500")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        held = balance(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in held) == 20_000
    assert len(held) == min(64, spark.sparkContext.defaultParallelism)


def test_posting_lists_of_slices_hold_every_trigram(monkeypatch):
    import pyarrow as pa

    from trendstream.operators import search_index as SI
    monkeypatch.setattr(SI, "BLOCK", 4)
    monkeypatch.setattr(SI, "CHUNK", 5)
    monkeypatch.setattr(SI, "SLICE", 12)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab\U0001f600é") for _ in range(rnd.randrange(0, 40))) + SI.PAD for _ in range(11)]
    batches = [pa.RecordBatch.from_pydict({"place": list(range(a, min(a + 3, 11))), "low": texts[a:a + 3]}) for a in range(0, 11, 3)]
    got = {}
    for out in SI.posting_lists(iter(batches)):
        for r in out.to_pylist():
            assert r["places"] == sorted(set(r["places"])) and {p // 4 for p in r["places"]} == {r["block"]}
            got.setdefault(r["trigram"], set()).update(r["places"])
    want = {}
    for place, t in enumerate(texts):
        for i in range(len(t) - 2):
            want.setdefault(t[i:i + 3], set()).add(place)
    assert got == want
    assert list(SI.posting_lists(iter([]))) == []


def test_waiting_alerts_cost_a_topic_few_state_calls():
    from types import SimpleNamespace

    from trendstream.streaming.episodes import Episodes
    calls = []

    class State:
        def __init__(self):
            self.held = None

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name in ("update", "put"):
                    self.held = list(args[0]) if name == "put" else args[0]
                elif name == "appendList":
                    self.held = [*(self.held or []), *args[0]]
                elif name == "clear":
                    self.held = None
                return self.held is not None if name == "exists" else iter(self.held) if name == "get" else None
            return call

    class Value(State):
        def get(self):
            calls.append("get")
            return self.held

    class Handle:
        timers = set()
        getListState = getMapState = lambda self, *a: State()
        getValueState = lambda self, *a: Value()

        def registerTimer(self, at):
            calls.append("timer")
            self.timers.add(at)

    p, minute, starts = Episodes(), 60_000_000, list(range(300))
    p.init(Handle())
    random.Random(1).shuffle(starts)
    rows = [dict(topic="t", start=s * minute, end=(s + 10) * minute, count=s) for s in [*starts, 7]]
    assert list(p.handleInputRows(("t",), iter(rows), None)) == []
    got = []
    for now in (99 * 60_000, 1000 * 60_000):
        for at in sorted(t for t in Handle.timers if t <= now):
            Handle.timers.discard(at)
            got += p.handleExpiredTimer(("t",), SimpleNamespace(getCurrentWatermarkInMs=lambda: now),
                                        SimpleNamespace(getExpiryTimeInMs=lambda: at))
    # of overlapping alerts the first opens the only episode
    assert [r["count"] for r in got] == [0]
    assert len(calls) < 60 and p.waiting.held is None


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_written_stage_leaves_no_shuffle_files(spark):
    import time
    from trendstream.session import FREE_SHUFFLES, materialize
    before, setting = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = materialize(counts.join(counts.withColumnRenamed("count", "n").hint("merge"), "k"))
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES) == setting
    assert sorted((r["k"], r["count"], r.n) for r in kept.collect()) == [(k, 143 - (k == 6), 143 - (k == 6)) for k in range(7)]


def test_sets_of_the_jaccard_join_are_shuffled_once_and_deleted(spark, monkeypatch):
    import os
    from trendstream.llm import jaccard as J
    from trendstream.session import shared_dir
    plans = {}

    def noted(df, kind="stage"):
        plans[kind] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, kind)

    write = J.materialize
    monkeypatch.setattr(J, "materialize", noted)
    base = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "other"])), (2, " ".join([*base[:-1], "other"])),
            (None, " ".join(["first", *base[1:]])), (5, "quite different words in here"), (6, None)]
    got = J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id is None, r.id or 0), r.component_id) for r in got) == [
        ((False, 1), 1), ((False, 2), 1), ((False, 2), 1), ((False, 5), 5), ((False, 6), 6), ((True, 0), 1)]
    # duplicates are dropped where the join has put them: the two sides' exchanges and no third
    assert plans["jaccard-sets"].count("Exchange hashpartitioning") == 2
    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("jaccard-sets-")]


def test_pipeline_sends_python_small_batches(spark, monkeypatch):
    """pipeline: a worker, and the task that feeds it, hold a bounded size of texts, not 10,000 whole ones."""
    import corpus_pipeline as CP
    import pyarrow as pa
    from trendstream.session import BATCH_BYTES, TEXT_BATCH

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    def told(docs, *_, **__):
        return docs.select("text").coalesce(1).mapInArrow(sizes, "rows long, bytes long")
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 800)").alias("text"))
    monkeypatch.setattr(CP, "pack", told)
    monkeypatch.setattr(CP, "drop_near_duplicates", told)
    monkeypatch.setattr(CP, "table", lambda *_: None)
    monkeypatch.setattr(CP, "fit", lambda *_: None)
    monkeypatch.setattr(CP, "with_scores", lambda docs, _, out: docs.withColumn(out, F.lit(1.0)))
    before = spark.conf.get(BATCH_BYTES)
    try:
        for stage in (CP.packing, CP.near_dedup, lambda *a: told(CP.accept(*a))):
            spark.conf.set(BATCH_BYTES, before)
            got = stage(spark, docs, "").collect()
            assert sum(r["rows"] for r in got) == 3000
            assert max(r["bytes"] for r in got) <= 2 * TEXT_BATCH
    finally:
        spark.conf.set(BATCH_BYTES, before)


def test_packing_keeps_a_small_table_in_its_worker():
    """pipeline: what the packing stage leaves in a worker, and ids when the table overflows."""
    from tokenizers import Tokenizer
    from trendstream.llm import packing
    from trendstream.llm.pieces import Encoder
    from trendstream.llm.queries import tokenizer_path
    kept = Encoder(tokenizer_path(), **packing.CACHE)
    slots = sum(a.nbytes for a in (kept.cache.h1, kept.cache.h2, kept.cache.size, kept.cache.first))
    assert slots + 2 * 4 * kept.want < 32e6
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcé '7\n.") for _ in range(rnd.randrange(300))) for _ in range(60)]
    library, small = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path(), bits=4, pool=64)
    for at in range(0, len(texts), 7):
        for text, ids in zip(texts[at:at + 7], small.ids(texts[at:at + 7])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_sorts_of_a_topics_history_have_more_tasks_for_more_rows(spark, monkeypatch):
    from trendstream.operators import longterm as LT
    rnd, t0 = random.Random(16), dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), rnd.choice(["a", "b", None, f"t{i % 200}"]), rnd.randrange(9)) for i in range(6000)]
    counts = spark.createDataFrame(rows, "windowStart timestamp_ntz, topic string, count bigint")
    want = {(r.windowStart, r.topic): (r["count"], r.baseline_avg, r.baseline_std, r.z)
            for r in LT.topic_anomaly(counts).collect()}
    monkeypatch.setattr(LT, "ROWS_A_TASK", 100, raising=False)
    got = LT.topic_anomaly(counts)
    by_task = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
    # chunks of a day (here at most some 500 rows) stay whole; before, the tasks were as many as the cores at most
    assert len(by_task) > spark.sparkContext.defaultParallelism and max(r["count"] for r in by_task) < 1000
    got = got.collect()
    assert len(got) == len(rows)
    assert {(r.windowStart, r.topic): (r["count"], r.baseline_avg, r.baseline_std, r.z) for r in got} == want
    mine = sorted(r for r in rows if r[1] == "a")
    for i, (at, topic, n) in enumerate(mine):
        before = [r[2] for r in mine[max(0, i - LT.ANOMALY_HISTORY):i]]
        assert want[at, topic][1] == (round(sum(before) / len(before), 6) if before else None)


def test_replayed_history_is_read_once_and_its_state_is_bounded(spark, monkeypatch, tmp_path):
    from trendstream.plans import catalog as C
    from trendstream.sources.topics import read_topic, stored_slices, time_slices
    rnd, t0 = random.Random(23), dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=rnd.randrange(40 * 3600)), rnd.randrange(5), "view", 1.0, "{}") for i in range(600)]
    events = spark.createDataFrame([*rows, (600, t0, 1, "view", 1.0, "{}")],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    events = events.unionByName(events.limit(2).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    # the same slices, rows without a time in the first
    cut = [sorted(r.event_id for r in part.collect()) for part in time_slices(events, "ts", 7)]
    assert [sorted(r.event_id for r in part.collect()) for part in stored_slices(events, "ts", 7)] == cut
    assert len(cut) == 7 and sum(map(len, cut)) == 603
    one = list(p.count() for p in stored_slices(events.where("ts is null"), "ts", 3))
    assert one == [2]
    # more events are more micro-batches, and state has as many partitions as the cores ask for
    monkeypatch.setattr(C, "EVENTS_A_SLICE", 100)
    assert C._replay(spark, str(tmp_path))[0] == 7
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(5 * cores))
    try:
        topic, out = C._enriched_topic(spark, str(tmp_path)), str(tmp_path / "counts")
        q = C._run_alert_stream(spark, topic, out, 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(5 * cores)
        got = {(r.windowStart, r.topic): r["count"] for r in C._read_alert_sink(spark, out).collect()}
        from trendstream.operators import trends as TR
        counts = TR.closed_windows(TR.topic_counts(C._topic_rows(spark, str(tmp_path))), C._topic_times(spark, str(tmp_path)))
        assert got == {(r.windowStart, r.topic): r["count"] for r in counts.collect()} and got
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert read_topic(spark, topic, "text", stream=False).count() == 601
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 7
    state = [p.name for p in (tmp_path / "counts.chk" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(state) == 2 * cores
