"""Compaction of the history table: exact for readers at every step."""

import datetime as dt
import re
from collections import Counter

from trendstream.operators import compaction as CP
from trendstream.operators import history as H
from trendstream.session import fresh_path

DAYS = [dt.datetime(2024, 1, 1 + d) for d in range(4)]


def rows(spark, batch, n=8):
    data = [(f"{batch}-{i}", f"text {i}", str(DAYS[(batch + i) % 4]) if i else None, "en", f"t{i % 3}") for i in range(n)]
    return spark.createDataFrame(data, "uniqueId string, content string, timestamp string, language string, topic string")


def ids(spark, loc, **kw):
    return sorted(r.UniqueId for r in H.read_history(spark, loc, **kw).collect())


def test_many_micro_batches_become_few_files(spark):
    loc = fresh_path(spark, "history")
    write = H.batch_writer(loc, "s")
    for b in range(30):
        write(rows(spark, b), b)
    want = sorted(f"{b}-{i}" for b in range(30) for i in range(8))
    assert ids(spark, loc) == want
    before = H.read_history(spark, loc)                       # a reader that began earlier
    files = len(before.inputFiles())
    assert CP.compact(spark, loc) > 100
    assert ids(spark, loc) == want and sorted(r.UniqueId for r in before.collect()) == want
    now = H.read_history(spark, loc)
    by_date = Counter(re.search("TweetDate=([^/]*)", f)[1] for f in now.inputFiles() if CP.SNAPSHOTS in f)
    assert len(now.inputFiles()) < files / 3 and len(by_date) == 5
    assert all(n <= CP.FILES_PER_DATE for n in by_date.values())          # the newest batch waits for the next compaction
    assert CP.compact(spark, loc) == 0

    # a covered batch repeated, new batches, a batch append: each row once
    write(rows(spark, 7), 7)
    for b in range(30, 33):
        write(rows(spark, b), b)
    H.append_batch(rows(spark, 99), loc)
    want = sorted(want + [f"{b}-{i}" for b in (30, 31, 32, 99) for i in range(8)])
    assert ids(spark, loc) == want
    middle = H.read_history(spark, loc)
    assert CP.compact(spark, loc) > 0 and ids(spark, loc) == want
    gone = CP.expire(spark, loc)
    assert gone > 100 and ids(spark, loc) == want
    assert sorted(r.UniqueId for r in H.read_history(spark, loc).where("TweetDate IS NULL").collect()) == [x for x in want if x.endswith("-0")]
    assert len(CP.partitions(spark, loc)) < 40
    # one more round: what is gone needs no cover
    write(rows(spark, 33), 33)
    write(rows(spark, 34), 34)
    CP.compact(spark, loc)
    CP.expire(spark, loc)
    assert len(CP.snapshot(spark, loc)["covers"]) <= 40
    assert ids(spark, loc) == sorted(want + [f"{b}-{i}" for b in (33, 34) for i in range(8)])
    del middle


def test_a_broken_compaction_changes_nothing(spark, monkeypatch):
    loc = fresh_path(spark, "history")
    for b in range(3):
        H.batch_writer(loc, "s")(rows(spark, b), b)
    want = ids(spark, loc)

    def fail(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(CP, "_point", fail)
        try:
            CP.compact(spark, loc)
        except OSError:
            pass
    assert ids(spark, loc) == want
    assert CP.compact(spark, loc) > 0 and ids(spark, loc) == want


def test_date_bounds_prune_compacted_dates(spark):
    loc = fresh_path(spark, "history")
    for b in range(4):
        H.batch_writer(loc, "s")(rows(spark, b), b)
    want = {k: ids(spark, loc, **k_) for k, k_ in {"a": {"since": "2024-01-02"}, "b": {"until": "2024-01-03"},
                                                   "c": {"since": "2024-01-02", "until": "2024-01-03"}}.items()}
    CP.compact(spark, loc)
    assert ids(spark, loc, since="2024-01-02") == want["a"] and ids(spark, loc, until="2024-01-03") == want["b"]
    assert ids(spark, loc, since="2024-01-02", until="2024-01-03") == want["c"]
    folders = H.read_history(spark, loc, since="2024-01-02", until="2024-01-03").inputFiles()
    assert folders and all("TweetDate=2024-01-02" in f for f in folders)
